"""Chat training text from every participant's point of view, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import running_before, stored

PART_TURNS = 256  # turns of one output row, at most

# Roles that speak to all participants and are never spoken by the model.
NARRATORS = ("system", "tool")


def escaped_body(text: Column) -> Column:
    """A body that cannot be taken for markup: ``<|`` becomes ``<\\|``.

    One more backslash is put where some stand between the two, so taking one out of each
    such place gives the body back. Other texts stay as they are. Null is empty.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def escaped_name(role: Column) -> Column:
    """A role as a name in markup: backslash, bar and line break are written with a backslash."""
    back, bar = "\\", "|"
    name = F.replace(F.replace(role, F.lit(back), F.lit(back + back)), F.lit(bar), F.lit(back + bar))
    return F.replace(name, F.lit("\n"), F.lit(back + "n"))


def _turn(turn: Column, speaker: Column) -> Column:
    """``(head, body, tail, trained)`` of a turn as ``speaker`` sees it."""
    role = turn["role"]
    mine = role.eqNullSafe(speaker)
    head = (
        F.when(mine, F.lit("<|assistant|>\n"))
        .when(role.isin(*NARRATORS), F.concat(F.lit("<|"), role, F.lit("|>\n")))
        .when(role.isNull(), F.lit("<|user|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), escaped_name(role), F.lit("|>\n")))
    )
    return F.struct(
        head.alias("head"),
        escaped_body(turn["body"]).alias("body"),
        F.lit("<|end|>\n").alias("tail"),
        mine.alias("trained"),
    )


def perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(conv, speaker, part, n_turns, text_start, text, mask)`` per conversation, participant, part.

    Each participant is a role that is neither null nor in ``NARRATORS``, taken as it is written:
    roles that differ at all are different participants. Its rendering has its own turns
    as the assistant's and the others' as those of users with their names. Bodies and names
    are escaped, so no text can start or end a turn.

    A rendering is the ``text`` of its parts, joined in order; a part has at most ``part_turns``
    turns, so that no row grows with a conversation. ``text_start`` is where the part stands in
    the rendering, and ``mask`` lists the spans to train on, as start and length in
    characters of the rendering: the bodies and end marks of the speaker's turns.

    Turns are ordered by number, null first, then role and text. Turns with a null role are
    rendered as those of a user without name, null texts as empty. Turns with a null
    conversation make one conversation. A conversation without participants has no
    rows. Repeated rows are repeated turns; other columns are not read. An empty
    table gives no rows.
    """
    rows = stored(
        turns.select(
            F.col(conv_col).alias("conv"),
            F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("key"),
            F.col(turn_col).alias("turn"),
            F.col(role_col).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("body"),
            F.lit(1).cast("long").alias("one"),
        ),
        "turns",
    )
    placed = running_before(rows, ["turn", "role", "body"], "one", "place", ["key"])
    parts = stored(
        placed.withColumn("part", F.floor(F.col("place") / part_turns).cast("int"))
        .groupBy("key", "part")
        .agg(
            F.first("conv").alias("conv"),
            F.sort_array(F.collect_list(F.struct("place", "role", "body"))).alias("turns"),
        ),
        "parts",
    )
    speakers = stored(
        rows.where(F.col("role").isNotNull() & ~F.col("role").isin(*NARRATORS))
        .select("key", F.col("role").alias("speaker"))
        .distinct(),
        "speakers",
    )
    seen = F.transform("turns", lambda t: _turn(t, F.col("speaker")))
    text = F.array_join(
        F.transform("seen", lambda t: F.concat(t["head"], t["body"], t["tail"])), ""
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("array(named_struct('start', 0, 'length', 0))").alias("spans"))

    def advance(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["head"])
        size = F.length(t["body"]) + F.length(t["tail"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct(
            (begin + size).alias("at"),
            F.when(t["trained"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    spans = F.aggregate("seen", start, advance, lambda s: F.slice(s["spans"], F.lit(2), F.size(s["spans"])))
    shown = stored(
        parts.join(speakers, "key")
        .withColumn("seen", seen)
        .select("key", "conv", "speaker", "part", F.size("turns").alias("n_turns"), text.alias("text"),
                spans.alias("spans"))
        .withColumn("chars", F.length("text").cast("long")),
        "renderings",
    )
    keys = ["key", "speaker", "part"]
    starts = running_before(shown.select(*keys, "chars"), ["part"], "chars", "text_start", ["key", "speaker"])
    mask = F.transform(
        "spans",
        lambda s: F.struct((s["start"] + F.col("text_start")).alias("start"), s["length"].cast("long").alias("length")),
    )
    return shown.join(starts.drop("chars"), keys).select(
        F.col("conv").alias(conv_col), "speaker", "part", "n_turns", "text_start", "text", mask.alias("mask")
    )
