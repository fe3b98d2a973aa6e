"""Quality rules as a ledger of failure bits.

Every rule is evaluated once. The ledger keeps what was measured and one bit per
failed rule; a policy is a mask of rules, so policies are applied, changed and
compared without reading a text again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import map_rows, utf8

SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long, n_letters long, n_capitals long"
)

# Rule name to condition of failure. A rule's bit is its place in this list; new
# rules are appended, so that old ledgers stay readable.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 5 * word_chars",
    "shouting": "2 * n_capitals > n_letters",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}

# Policy version to the rules that it applies.
POLICIES = {
    "base-1": ["few_words", "repeated_windows"],
    "standard-2": ["few_words", "repeated_windows", "symbols", "shouting", "word_length"],
    "strict-3": list(RULES),
}


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def _codes(columns: list[np.ndarray]) -> np.ndarray:
    """One integer per row, equal where all columns are; refolded so that it never overflows."""
    codes = columns[0]
    for column in columns[1:]:
        codes = codes * (int(column.max()) + 1) + column
        codes = np.unique(codes, return_inverse=True)[1]
    return codes


def _repeated(words: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    windows = _codes([ids[:-2], ids[1:-1], ids[2:]])
    again = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))


def _measure(text: bytes) -> tuple:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = [len(text) - len(text.translate(None, kind)) for kind in (SYMBOLS, _LETTERS, _CAPITALS)]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        without[0],
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(words),
        without[1],
        without[2],
    )


def ledger(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    extra: dict[str, Callable[[bytes], int]] | None = None,
) -> DataFrame:
    """One row ``(id, measures, fail_bits)`` per document; ``extra`` adds measures of its own.

    A null or blank text has no words and fails ``few_words``. Repeated rows and
    null ids are rows like any other; further columns of ``docs`` are not read.
    Words are cut at ASCII white space, lines at line feeds; a line counts if it
    has a word.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    more = extra or {}
    schema = ", ".join([f"id {id_type}", MEASURES, *[f"{name} long" for name in more]])

    def measured(batch: dict) -> list[tuple]:
        return [
            (i, *_measure(t), *[f(t) for f in more.values()])
            for i, t in zip(batch["id"], batch["text"])
        ]

    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    out = map_rows(rows, measured, schema)
    bits = [
        F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
        for bit, condition in enumerate(RULES.values())
    ]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return out.withColumn("fail_bits", total).withColumnRenamed("id", id_col)


def passes(policy: str) -> Column:
    """True for the rows of a ledger that fail no rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    return rows.withColumn("policy", F.lit(policy)).withColumn("kept", passes(policy))


def ablations(rows: DataFrame, policies: list[str] | None = None) -> DataFrame:
    """Per policy and rule: documents that fail the rule, and those that fail no other rule.

    ``sole`` is what the policy would gain by dropping the rule. Documents are
    first counted per bit pattern, so everything after that is a few rows.
    """
    names = list(RULES)
    asked = [
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                 F.lit(mask(p)).cast("long").alias("mask"),
                 F.lit(1 << names.index(r)).cast("long").alias("bit"))
        for p in (policies or POLICIES) for r in POLICIES[p]
    ]
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    each = patterns.select("fail_bits", "n", F.inline(F.array(*asked)))
    failed = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    sole = F.col("fail_bits").bitwiseAND(F.col("mask")) == F.col("bit")
    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("documents"),
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(sole, F.col("n")).otherwise(0)).alias("sole"),
    )
