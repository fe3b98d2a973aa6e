"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import WORD, fresh, running_before, stored


SEED = 17


def shuffle_key(seed: int, id_col: str, text_col: str) -> Column:
    """The place of a document in its shuffled source."""
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: list[int], share: float, epochs: int
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Weights repeat over the sources in code point order, null last. Targets share
    ``share`` times all sizes by weight, none above ``epochs`` times its source; what
    is above goes to the others by weight, until none is above. In order of
    ``source_size / weight`` the capped sources come first, so the level that the
    others get per weight follows from running sums.
    """
    named = sizes.withColumn("missing", F.col("source").isNull().cast("int")).withColumn(
        "name", F.coalesce("source", F.lit(""))
    )
    ranked = running_before(
        stored(named.withColumn("one", F.lit(1).cast("long")), "sources"),
        ["missing", "name"],
        "one",
        "place",
    )
    each = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1
    )
    weighted = stored(
        ranked.withColumn("weight", each.cast("long"))
        .withColumn("cap", F.lit(epochs).cast("long") * F.col("source_size"))
        .withColumn("fill", F.col("cap") / F.col("weight")),
        "weights",
    )
    total = weighted.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    budget, all_weights = share * (total["n"] or 0), total["w"] or 0
    order = ["fill", "missing", "name"]
    capped = running_before(weighted, order, "cap", "cap_before")
    run = running_before(stored(capped, "caps"), order, "weight", "weight_before")
    # The level if this source is the first that is not capped; the right one is the
    # lowest that its own source can hold.
    level = (F.lit(budget) - F.col("cap_before")) / (F.lit(all_weights) - F.col("weight_before"))
    levels = stored(run.withColumn("level", level), "levels")
    found = levels.where("level <= fill").agg(F.min_by("level", F.struct(*order))).first()[0]
    level = F.lit(found if found is not None else float("inf"))
    return levels.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(id, size, source_size, target, taken, copies, finishes)`` per document.

    Each source is a queue of its documents in hash order, up to ``epochs`` times over. A
    copy's virtual finish time is the words of its source up to its end, divided by the
    source's target, so at any time all sources are served in proportion. Copies are sorted
    by finish time across all sources and taken until the words reach the sum of targets;
    the first copy that would go beyond it ends the mix. Only whole documents are taken.

    ``finishes`` holds the finish time of each copy taken, by which the mix is ordered.
    Documents without words are never taken. Null texts have no words; null sources
    are one source, the last. Rows equal in all read columns tie; at the end of the mix
    such rows are taken together. An empty table gives no rows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(text_col).alias("size"),
            shuffle_key(seed, id_col, text_col).alias("shuffle"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, list(weights), share, epochs), "targets")
    same = F.col("source").eqNullSafe(F.col("s"))
    joined = rows.join(
        targets.withColumnRenamed("source", "s"), same
    ).withColumn("queue", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    queued = running_before(
        stored(joined.drop("s"), "queued"), ["shuffle", "id"], "size", "before", ["queue"]
    )
    first = F.col("before") + F.col("size")
    finishes = F.array(
        *[(first + F.lit(e).cast("long") * F.col("source_size"))
          / F.nullif("target", F.lit(0.0))
          for e in range(epochs)]
    )
    timed = stored(queued.withColumn("all_finishes", finishes).drop("before"), "timed")
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    copies = (
        timed.where("size > 0")
        .select("queue", "shuffle", "id", "size", F.posexplode("all_finishes").alias("epoch", "finish"))
    )
    order = ["finish", "queue", "shuffle", "id", "epoch"]
    run = running_before(stored(copies, "copies"), order, "size", "words_before")
    key = F.struct(*order)
    last = (
        run.where(F.col("words_before") + F.col("size") <= F.lit(budget + 1e-6))
        .agg(F.max(key).alias("key"))
        .first()["key"]
    )

    def chosen(finish: Column, epoch: Column) -> Column:
        if last is None:
            return F.lit(False)
        here = F.struct(finish, F.col("queue"), F.col("shuffle"), F.col("id"), epoch)
        kinds = [copies.schema[c].dataType for c in order]
        there = F.struct(*[F.lit(last[c]).cast(k) for c, k in zip(order, kinds)])
        return here <= there

    taken = F.filter(
        "all_finishes", lambda finish, epoch: (F.col("size") > 0) & chosen(finish, epoch)
    )
    return (
        timed.withColumn("finishes", taken)
        .withColumn("copies", F.size("finishes"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .withColumnRenamed("id", id_col)
        .select(id_col, "size", "source_size", "target", "taken", "copies", "finishes", "shuffle")
    )


def mixed_documents(
    docs: DataFrame, plan: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, each as often as ``plan`` from ``mix_sources`` takes it.

    Rows equal in id and text are told apart by number, so each gets its own copies: the plan
    says how many of them are taken a first time, a second time and so on. Rows are numbered and
    joined by the same key, so texts are shuffled once. The id is in a struct, since null
    equals null in there.
    """
    key, place, number, turn, rows = fresh(docs, "mix_key", "mix_place", "mix_number", "mix_turn", "mix_rows")
    wanted = (
        plan.where("copies > 0")
        .select(
            F.struct(F.col(id_col).alias("id")).alias(key),
            F.col("shuffle").alias(place),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(turn),
        )
        .groupBy(key, place, turn)
        .agg(F.count(F.lit(1)).alias(rows))
    )
    numbered = (
        docs.withColumn(key, F.struct(F.col(id_col).alias("id")))
        .withColumn(place, shuffle_key(seed, id_col, text_col))
        .withColumn(number, F.row_number().over(Window.partitionBy(key, place).orderBy(place)))
    )
    return (
        numbered.join(wanted, [key, place])
        .where(F.col(number) <= F.col(rows))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
