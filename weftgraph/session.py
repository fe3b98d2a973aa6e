"""Session settings, the shared folder and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(app: str, cores: str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder. A cluster session must
    name one, since a folder on one machine is lost with that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="weftgraph-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that is put back, or unset again, at the end."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """While this holds, the shuffle files of a query go as soon as it has ended.

    Else they stay until the driver happens to collect its garbage. A later plan that needs them
    makes them anew.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def cut(df: DataFrame, *measures) -> tuple[DataFrame, dict, str]:
    """``materialize`` with the path of the files, for those that are discarded later."""
    seen, path = Observation(), scratch_path(df.sparkSession, "cut")
    rows = F.count(F.lit(1)).alias("rows")
    with shuffles_dropped(df.sparkSession):
        df.observe(seen, rows, *measures).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get, path


def materialize(df: DataFrame, *measures) -> tuple[DataFrame, dict]:
    """Writes ``df`` below the shared folder and returns it read back, with measures taken on the way.

    The files outlive lost executors and later plans start from them. They are compressed
    columns, as a checkpoint of rows takes more disk, and what was shuffled for them is dropped. ``rows``
    is always measured; as it is observed by the same job, a loop can test for an empty frame for free.
    """
    return cut(df, *measures)[:2]


def discard(spark: SparkSession, path: str) -> None:
    """Deletes files of ``cut`` that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def partitions_for(spark: SparkSession, rows: int, most: int = 4_000_000) -> int:
    """Partition count for ``rows`` narrow rows: spill-free, and one per core if worth it."""
    least = 1_000
    cores = min(spark.sparkContext.defaultParallelism, -(-rows // least))
    return max(1, cores, -(-rows // most))


def shuffling_into(spark: SparkSession, partitions: int):
    """Plans shuffles of a loop into as many partitions as the data it is joined to has.

    With another number, Spark would shuffle that data again at every step.
    """
    return setting(spark, "spark.sql.shuffle.partitions", str(partitions))
