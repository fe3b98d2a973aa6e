"""Tables of results: medians, pivots, merges and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.session import materialize, partitions_for


def grouped_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The exact median of ``value`` per group, as ``(*keys, n, median)``.

    Null values do not count. The built-in median would keep the values of a group in one
    task, so values are sorted across the cluster: a large group spans many range
    partitions, since the value is part of the range key and equal values are counted into
    one row before. Totals per group and partition give the rows before each
    partition; only the partitions that hold a middle rank are then ranked, each on its
    own.
    """
    spark = df.sparkSession
    data = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("x")
    )
    counted, seen = materialize(data.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c")))
    ordered, _ = materialize(
        counted.repartitionByRange(partitions_for(spark, seen["rows"]), *keys, "x").withColumn(
            "part", F.spark_partition_id()
        )
    )
    group = Window.partitionBy(*keys)
    totals = (
        ordered.groupBy(*keys, "part")
        .agg(F.sum("c").alias("c"))
        .withColumn("n", F.sum("c").over(group))
        .withColumn("before", F.sum("c").over(group.orderBy("part")) - F.col("c"))
    )
    lower, upper = F.expr("(n - 1) div 2"), F.expr("n div 2")
    here = (F.col("before") <= upper) & (lower < F.col("before") + F.col("c"))
    places = [*keys, "part"]
    wanted = totals.where(here).select(
        *[F.col(name).alias(f"wanted_{name}") for name in places], "n", "before"
    )
    match = [F.col(name).eqNullSafe(F.col(f"wanted_{name}")) for name in places]
    inside = ordered.join(wanted, match).select(*places, "x", "c", "n", "before")
    running = Window.partitionBy(*keys, "part").orderBy("x")
    last = F.col("before") + F.sum("c").over(running)
    ranked = inside.withColumn("last", last).withColumn("first", F.col("last") - F.col("c"))
    low = F.when((F.col("first") <= lower) & (lower < F.col("last")), F.col("x"))
    high = F.when((F.col("first") <= upper) & (upper < F.col("last")), F.col("x"))
    return (
        ranked.select(*keys, "n", low.alias("low"), high.alias("high"))
        .groupBy(*keys, "n")
        .agg(((F.max("low") + F.max("high")) / 2).alias("median"))
        .select(*keys, "n", "median")
    )


def timing_pivot(
    log: DataFrame,
    systems: list,
    metric: str = "metric",
    system: str = "system",
    value: str = "sec",
) -> DataFrame:
    """One row per metric with the median value of each system as a column."""
    medians = grouped_median(log, [metric, system], value)
    return medians.groupBy(metric).pivot(system, systems).agg(F.first("median"))


def merge_results(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with all rows of the keys found in ``new`` replaced by those of ``new``."""
    rerun = new.select(*[F.col(c).alias(f"new_{c}") for c in keys]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in keys]
    return old.join(rerun, same, "left_anti").unionByName(new)


def ledger_reconcile(balances: DataFrame, deltas: DataFrame, initial: int = 1000) -> DataFrame:
    """Stored against expected balance per account.

    ``balances`` is ``(id, balance)``, ``deltas`` is ``(id, delta)``. An account is
    consistent if its balance is ``initial`` plus the sum of its deltas.
    """
    moved = deltas.groupBy("id").agg(F.sum("delta").alias("moved"))
    expected = F.lit(initial).cast("bigint") + F.coalesce("moved", F.lit(0).cast("bigint"))
    return balances.join(moved, "id", "left").select(
        "id",
        F.col("balance").alias("final_balance"),
        expected.alias("expected_balance"),
        (F.col("balance") == expected).alias("consistent"),
    )


def metric_diff(left: DataFrame, right: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Two result tables ``(metric, value)`` side by side.

    ``same`` is false for a difference above ``tol`` and for a metric that only
    one side has. Two nulls are the same, and so are two NaNs.
    """
    a = left.select("metric", F.col("value").alias("left_value"), F.lit(True).alias("in_left"))
    b = right.select("metric", F.col("value").alias("right_value"), F.lit(True).alias("in_right"))
    x, y = F.col("left_value"), F.col("right_value")
    close = (F.abs(x - y) <= tol) | x.eqNullSafe(y)
    found = F.col("in_left") & F.col("in_right") & close
    return a.join(b, "metric", "full").select(
        "metric", "left_value", "right_value", F.coalesce(found, F.lit(False)).alias("same")
    )
