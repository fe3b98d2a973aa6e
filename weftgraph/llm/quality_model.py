"""Quality classifier from weak labels.

Overlapping labellers (text heuristics, a short word list and whatever human labels
exist) vote good, bad or nothing on every document. Expectation-maximisation over
the counts of vote patterns estimates how far each labeller can be trusted, without
any of them being taken for the truth. The posteriors then train a linear scorer on
hashed features, and the scorer judges all documents. There are two aspects,
``quality`` and ``toxic``; a document is kept if it is good in both.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from weftgraph.llm.common import fresh, map_rows, stored, utf8
from weftgraph.llm.quality_rules import ledger

DIMENSIONS = 1 << 18
SAMPLE = 10_000  # documents that the scorers are trained on, at most

# Insults of the languages at hand, as a starting point for the toxic aspect.
INSULTS = [
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless",
    "disgusting", "clown", "dumb", "jerk", "fool", "imbecile", "coward", "filth", "vermin",
    "freak", "creep", "brainless", "lowlife", "dimwit", "dummkopf", "trottel", "abschaum",
    "arschloch", "versager", "connard", "ordure", "salaud", "minable", "abruti", "idiota",
    "imbécil", "estúpido", "basura", "asqueroso", "payaso", "inútil",
]

# Turns of contempt and threat, each two or three words.
HOSTILE = [
    "shut up", "go away", "hate you", "hurt you", "kill you", "kill yourself", "get lost",
    "drop dead", "you people", "you make me", "nobody likes you", "halt die klappe", "hasse dich",
    "ferme la", "te déteste", "te odio", "cállate ya",
]


def _vote(bad: str, good: str = "false") -> str:
    return f"case when {bad} then -1 when {good} then 1 else 0 end"


# Aspect to labellers. Votes on the measures of the rule ledger; -1 is bad, 1 is good.
LABELLERS = {
    "quality": {
        "human": _vote("quality = 0", "quality = 1"),
        "symbols": _vote("100 * n_symbols > 5 * word_chars"),
        "shouting": _vote("2 * n_capitals > n_letters"),
        "repetition": _vote("3 * n_repeat_words > n_words"),
        "word_length": _vote("word_chars > 15 * n_words or word_chars < 2 * n_words"),
        "lines": _vote("2 * n_dup_lines > n_lines"),
        "short": _vote("n_words < 20"),
    },
    "toxic": {
        "human": _vote("toxic = 1", "toxic = 0"),
        "insult": _vote("n_insults >= 1"),
        "insults": _vote("n_insults >= 3"),
        "hostile": _vote("n_hostile >= 1"),
        "outcry": _vote("n_outcries >= 3 and n_hostile + n_insults >= 1"),
    },
}


# What is known of labellers beforehand: an accuracy, and how many times their votes it counts
# for. People who read a text are mostly right, and without some such knowledge the hidden
# class drifts to whatever the heuristics agree on.
EXPECTED = {"human": (0.98, 4.0)}
HEURISTIC = (0.9, 1.0)  # what is expected of any other labeller


def estimate(
    patterns: list[tuple[tuple[int, ...], int]],
    expected: dict[int, tuple[float, float]],
    steps: int = 60,
) -> dict:
    """Labeller models from counted vote patterns, by expectation-maximisation.

    Labellers are taken as independent given the hidden class. Returns the share of good
    documents, ``p[class][labeller][vote]`` (class 0 bad, 1 good; votes -1, 0, 1) and the
    estimated accuracy of each labeller where it votes. ``expected`` maps labellers to an
    accuracy and how many times their votes it counts for beside what is counted. How often
    a labeller votes which way is estimated for both classes. That it is silent is taken to tell
    nothing, since a kind of bad text that few heuristics know would pass for good otherwise.
    """
    votes = np.array([p for p, _ in patterns], int)
    counts = np.array([n for _, n in patterns], float)
    onehot = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)
    first = np.array([expected.get(j, (0.9, 0))[0] for j in range(votes.shape[1])])
    told = onehot * np.array([1, 0, 1])
    cast = np.einsum("n,nlv->lv", counts, onehot)
    before = np.full((2, votes.shape[1], 3), 0.5)
    for j, (accuracy, share) in expected.items():
        bad, good = share * cast[j, 0], share * cast[j, 2]
        before[:, j, 0] += bad * np.array([accuracy, 1 - accuracy])
        before[:, j, 2] += good * np.array([1 - accuracy, accuracy])
    # Silence tells nothing, so it cannot tell the share of the classes either. That comes from
    # what expected labellers that vote both ways say, else from all documents with votes, or
    # where votes only go one way, from how many documents nobody has called bad.
    spoken = (votes != 0).any(1)
    voted = sum((cast[j] for j in expected if cast[j, 0] and cast[j, 2]), np.zeros(3))
    if voted[0] + voted[2]:
        part = (voted[2] + 1) / (voted[0] + voted[2] + 2)
    else:
        part = 1 - counts[(votes < 0).any(1)].sum() / counts.sum()
    share = np.array([1 - part, part]).clip(0.01, 0.99)
    settled = voted[0] + voted[2] > 0 or not (votes > 0).any()
    good = 1 / (1 + np.exp(-(votes @ np.log(first / (1 - first)) + 3)))
    for _ in range(steps):
        both = np.stack([counts * (1 - good), counts * good])
        p = np.einsum("cn,nlv->clv", both, onehot) + before
        p /= p.sum(2, keepdims=True)
        if not settled:
            share = np.clip(both[:, spoken].sum(1) / counts[spoken].sum(), 1e-6, 1)
        log = np.log(share)[:, None] + np.einsum("nlv,clv->cn", told, np.log(p))
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
    right = share[0] * p[0, :, 0] + share[1] * p[1, :, 2]
    wrong = share[0] * p[0, :, 2] + share[1] * p[1, :, 0]
    return {"share": share, "p": p, "accuracy": right / (right + wrong)}


def posterior(votes: list[Column], model: dict) -> Column:
    """Probability of the good class given the votes."""
    share, p = model["share"], model["p"]
    odds = F.lit(float(np.log(share[1] / share[0])))
    for j, vote in enumerate(votes):
        gains = np.log(p[1, j] / p[0, j]) * [1, 0, 1]
        odds = odds + F.element_at(F.array(*[F.lit(float(g)) for g in gains]), vote + 2)
    return 1 / (1 + F.exp(-odds))


_LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum())
# Bytes that are no letters or digits become spaces.
_FOLD = bytes(c if c in _LETTERS else 32 for c in range(256))


def features(text: bytes) -> np.ndarray:
    """Hashed features of a text: its words, their stems, its marks and its shape."""
    tokens = text.split()
    kinds = set(tokens)
    words = set(text.lower().translate(_FOLD).split())
    # What is left of each token without its letters: punctuation, or the whole token.
    marks = [token.translate(None, _LETTERS) for token in kinds]
    alone = {token for token, mark in zip(kinds, marks) if len(mark) == len(token)}
    capitals = sum(1 for token in kinds if len(token) > 1 and token.isupper())
    variety = b"u%d" % (10 * len(kinds) // max(1, len(tokens)))
    size = b"n%d" % len(tokens).bit_length()
    shape = (
        variety,
        size,
        variety + size,
        b"c%d" % (10 * capitals // max(1, len(kinds))),
        b"a%d" % (20 * sum(1 for token in tokens if token in alone) // max(1, len(tokens))),
    )
    found = [crc32(word) for word in words]
    # Each kind of feature starts the checksum from a number of its own.
    found += [crc32(stem, 1) for stem in {word[:4] for word in words if len(word) > 3}]
    found += [crc32(stem, 2) for stem in {word[:5] for word in words if len(word) > 3}]
    found += [crc32(mark, 3) for mark in {mark[:4] for mark in marks if len(mark) > 1}]
    found += [crc32(part, 4) for part in shape]
    return np.unique(np.array(found, np.uint32) % np.uint32(DIMENSIONS)).astype(np.int32)


@dataclass
class Scorer:
    """Weights of one aspect; the score is the probability of the good class.

    ``used`` marks the features that differ between the classes; a text is scored on
    those alone, over the square root of their number.
    """

    used: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, at: np.ndarray) -> float:
        at = at[self.used[at]]
        margin = float(self.weights[at].sum()) / np.sqrt(len(at) + 1) + self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


def constant(bias: float) -> Scorer:
    return Scorer(np.zeros(DIMENSIONS, bool), np.zeros(DIMENSIONS, np.float32), bias)


MIN_ROWS, MIN_DEVIATIONS = 4, 4.0
SILENT = 0.1  # weight of a training document on which no labeller has voted


def train(
    rows: list[np.ndarray], targets: np.ndarray, prior: float, steps: int = 150, rate: float = 0.5
) -> Scorer:
    """Logistic regression with soft targets, classes weighed alike, by adaptive gradients.

    A row counts as far as its target says more than ``prior``, the share of good documents,
    and at least ``SILENT``. A feature is used if it is in ``MIN_ROWS`` rows and its share of good rows is
    ``MIN_DEVIATIONS`` standard deviations off the average; the many rare words of a corpus
    would otherwise be learned by heart. Without two classes the scorer is constant.
    """
    telling = np.where(targets >= prior, targets - prior, 0) / max(1 - prior, 1e-9)
    telling = np.maximum(telling, np.where(targets < prior, prior - targets, 0) / max(prior, 1e-9))
    telling = np.maximum(telling, SILENT)
    share = float((telling * targets).sum() / telling.sum()) if len(targets) else prior
    if share > 1 - 1e-9 or share < 1e-9 or not len(targets):
        return constant(10.0 if share > 0.5 else -10.0)
    at = np.concatenate(rows)
    sizes = [len(r) for r in rows]
    n = np.bincount(at, minlength=DIMENSIONS)
    weight = np.bincount(at, np.repeat(telling, sizes), DIMENSIONS)
    off = np.bincount(at, np.repeat(telling * targets, sizes), DIMENSIONS) - weight * share
    used = (n >= MIN_ROWS) & (np.abs(off) >= MIN_DEVIATIONS * np.sqrt(weight * share * (1 - share)))
    rows = [r[used[r]] for r in rows]
    lengths = np.array([len(r) for r in rows])
    at = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), lengths)
    scale = 1 / np.sqrt(lengths + 1)
    importance = telling * (targets / share + (1 - targets) / (1 - share)) / (2 * telling.sum())
    weights, bias = np.zeros(DIMENSIONS), 0.0
    seen, seen_bias = np.full(DIMENSIONS, 1e-6), 1e-6
    for _ in range(steps):
        margin = np.bincount(row, weights[at], len(rows)) * scale + bias
        error = importance * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - targets)
        slope = np.bincount(at, (error * scale)[row], DIMENSIONS) + 1e-5 * weights
        seen += slope * slope
        weights -= rate * slope / np.sqrt(seen)
        seen_bias += error.sum() ** 2
        bias -= rate * error.sum() / np.sqrt(seen_bias)
    return Scorer(used, weights.astype(np.float32), float(bias))


_INSULTS = {w.encode() for w in INSULTS}
_HOSTILE = [b" " + w.encode() + b" " for w in HOSTILE]


def _insults(text: bytes) -> int:
    return len(_INSULTS.intersection(text.lower().translate(_FOLD).split()))


def _hostile(text: bytes) -> int:
    plain = b" " + b" ".join(text.lower().translate(_FOLD).split()) + b" "
    return sum(1 for phrase in _HOSTILE if phrase in plain)


def _outcries(text: bytes) -> int:
    return text.count(b"!")


@dataclass
class QualityModel:
    labellers: dict[str, dict]
    scorers: dict[str, Scorer]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    labellers: dict[str, dict[str, str]] | None = None,
) -> QualityModel:
    """Estimates the labellers over all documents and trains the scorers on a sample.

    Votes are counted over every document; the driver sees counts per vote pattern. The
    scorers train on the posteriors of at most ``sample`` documents, half of them with a
    human label and half without (more of one kind where the other has fewer), the first ones
    by a hash of the id, which come to the driver as feature numbers. ``labellers`` are aspect
    to name to vote, ``LABELLERS`` if not given.

    Null and empty texts are documents without words, very long ones are read whole, and
    rows with a null id are counted but not trained on; repeated rows count again. Several
    labels of a document count as the worst of them. An empty table gives a model that keeps
    everything, and so does one in which no labeller votes. The heuristics only call documents
    bad, so some human labels are needed for scorers of any use; tests measure how few.
    """
    labellers = labellers or LABELLERS
    id_type = docs.schema[id_col].dataType.simpleString()

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    human = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    measured = ledger(named, "id", "text", extra={"n_insults": _insults, "n_hostile": _hostile, "n_outcries": _outcries})
    joined = measured.join(human, "id", "left")
    arrays = [
        F.array(*[F.expr(vote) for vote in group.values()]).alias(aspect)
        for aspect, group in labellers.items()
    ]
    voted = stored(
        joined.select("id", *arrays, F.coalesce("quality", "toxic").isNotNull().alias("labelled")),
        "votes",
    )
    models = {}
    for aspect in labellers:
        rows = voted.groupBy(aspect).agg(F.count(F.lit(1)).alias("n")).collect()
        counted = sorted((tuple(r[aspect]), r["n"]) for r in rows)
        if counted:
            known = {j: EXPECTED.get(n, HEURISTIC) for j, n in enumerate(labellers[aspect])}
            models[aspect] = estimate(counted, known)
    if not models:
        return QualityModel({}, {aspect: constant(10.0) for aspect in labellers})
    targets = [
        posterior([F.element_at(aspect, j + 1) for j in range(len(labellers[aspect]))], model).alias(
            f"good_{aspect}"
        )
        for aspect, model in models.items()
    ]
    # Places count within each kind, so the two take turns until one runs out.
    named_votes = voted.where(F.col("id").isNotNull()).select("id", "labelled", *targets)
    kinds = [
        named_votes.where(F.col("labelled") == kind).orderBy(F.xxhash64("id"), "id").limit(sample)
        for kind in (True, False)
    ]
    place = F.row_number().over(Window.partitionBy("labelled").orderBy(F.xxhash64("id"), "id"))
    chosen = (
        kinds[0].unionAll(kinds[1]).withColumn("place", place)
        .orderBy("place", F.desc("labelled")).limit(sample).drop("place", "labelled")
    )
    # At most ``sample`` ids, so the small side may be broadcast.
    training = named.join(F.broadcast(stored(chosen, "sample")), "id")
    goods = [f"good_{aspect}" for aspect in models]

    def featured(batch: dict) -> list[tuple]:
        at = [features(t).tobytes() for t in batch["text"]]
        return list(zip(batch["id"], at, *[batch[g] for g in goods]))

    rows = (
        map_rows(
            training.select("id", utf8("text").alias("text"), *goods),
            featured,
            f"id {id_type}, at binary, " + ", ".join(f"{g} double" for g in goods),
        )
        .orderBy("id", "at")
        .limit(sample)
        .collect()
    )
    at = [np.frombuffer(r["at"], np.int32) for r in rows]
    scorers = {
        aspect: train(
            at, np.array([r[f"good_{aspect}"] for r in rows]), float(models[aspect]["share"][1])
        )
        for aspect in models
    }
    return QualityModel(models, scorers)


_JUDGED = [
    StructField("p_quality", DoubleType()),
    StructField("p_clean", DoubleType()),
    StructField("kept", BooleanType()),
]


def classify(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``p_quality``, ``p_clean`` (not toxic) and ``kept``.

    Every row is judged by its text alone. A null text counts as an empty one. Columns of
    ``docs`` that have these names are replaced.
    """
    scorers = model.scorers
    out = docs.drop("p_quality", "p_clean", "kept")
    names = out.columns
    (content,) = fresh(out, "content")

    def judged(batch: dict) -> list[tuple]:
        rows = []
        for k, text in enumerate(batch[content]):
            at = features(text)
            good, clean = scorers["quality"].score(at), scorers["toxic"].score(at)
            rows.append(
                (*[batch[n][k] for n in names], good, clean, good >= 0.5 and clean >= 0.5)
            )
        return rows

    schema = StructType(out.schema.fields + _JUDGED)
    return map_rows(out.withColumn(content, utf8(text_col)), judged, schema)
