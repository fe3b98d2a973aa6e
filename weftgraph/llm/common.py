"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from weftgraph.session import partitions_for, scratch_path

# The white space of words, and the characters of license words.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BATCH = 1_000
BYTES_PER_BATCH = 4_000_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
REMEMBERED = 200_000  # words of at most 64 bytes whose hashes a task remembers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    Later plans start from the files, which outlive lost executors, and read
    only the columns that they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(text: str) -> Column:
    """The bytes of a text; a null text is empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each made unlike any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


_AT_END: list[Callable[[], None]] = []


def at_end_of_task(clear: Callable[[], None]) -> None:
    """Has ``clear`` called at the end of every ``in_batches`` task of this worker."""
    if clear not in _AT_END:
        _AT_END.append(clear)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``ROWS_PER_BATCH`` rows and, but for one row, ``BYTES_PER_BATCH``."""
    at = 0
    while at < batch.num_rows:
        rows = min(ROWS_PER_BATCH, batch.num_rows - at)
        while rows > 1 and _bytes(batch, at, rows) > BYTES_PER_BATCH:
            rows = max(1, rows // 2)
        yield batch.slice(at, rows)
        at += rows


def _bytes(batch: pa.RecordBatch, at: int, rows: int) -> int:
    return sum(column.nbytes for column in batch.slice(at, rows).columns)


def in_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` that leaves no memory behind: what a task remembered goes at its end.

    Workers live on from task to task and from stage to stage, and so would their caches.
    Spark sends batches of about ``BYTES_PER_BATCH``, unless the session has set a size of its own:
    by default they are of 10,000 rows up to 64 MB, which executor and worker hold once more each.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BYTES_PER_BATCH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            for clear in _AT_END:
                clear()
            pa.default_memory_pool().release_unused()
            _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Returns freed memory to the system where the C library can (glibc)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_rows(
    df: DataFrame, function: Callable[[dict], list[tuple]], schema: str | StructType
) -> DataFrame:
    """Rows that ``function`` makes of each batch of columns, given as name to list.

    Input and output are taken in parts of bounded size.
    """
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in struct.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                rows = function(columns)
                if rows:
                    lists = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, f.type) for v, f in zip(lists, kinds)], schema=kinds
                    )

    return in_batches(df, run, struct)


_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hashes of words; those met first are remembered until the task ends."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word, self.seed)
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = number
        return number


_HASHES = [_WordHashes(0), _WordHashes(1)]


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """The hash of each word; the two seeds give independent ones."""
    at_end_of_task(_HASHES[seed].clear)
    return np.fromiter(map(_HASHES[seed].__getitem__, words), np.uint64, len(words))


def in_tasks(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """``df``, made by about ``rows`` rows, in no more tasks than these are worth.

    Loops over small frames otherwise pay for all shuffle partitions at each step.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // per_task)))


def sized(df: DataFrame) -> int:
    """Partitions for the rows of a stored frame; the count comes from file footers."""
    return partitions_for(df.sparkSession, df.count())


def running_before(
    df: DataFrame, order: list[str], value: str, out: str, group: list[str] | None = None
) -> DataFrame:
    """``df`` (a stored frame) with the sum of ``value`` over the earlier rows of its group.

    No task sees a whole group: rows are dealt to ranges of (group, order), each
    range is summed, the sums of the ranges are run up, and rows are numbered
    inside their range only. Rows equal in group and order come in any order, and as their
    place in the stored frame tells them apart, in as many ranges as they need.
    ``group`` columns must not be null.
    """
    group = group or []
    ranged = stored(
        df.withColumn("stored_at", F.monotonically_increasing_id())
        .repartitionByRange(sized(df), *group, *order, "stored_at")
        .withColumn("slice", F.spark_partition_id())
        .drop("stored_at"),
        "ranged",
    )
    up = Window.partitionBy(*group).orderBy("slice") if group else Window.orderBy("slice")
    totals = (
        ranged.groupBy(*group, "slice")
        .agg(F.sum(value).alias("slice_sum"))
        .withColumn(
            "slice_before",
            F.coalesce(
                F.sum("slice_sum").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("slice_sum")
    )
    inside = Window.partitionBy(*group, "slice").orderBy(*order)
    earlier = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranged.join(totals, [*group, "slice"])
        .withColumn(out, F.col("slice_before") + F.coalesce(earlier, F.lit(0)))
        .drop("slice", "slice_before")
    )
