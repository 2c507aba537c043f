"""Reading the given tables, and written tables that cut a lineage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_own: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application, so that none needs it installed.

    Where the session sets no bound of an Arrow batch (Spark's own is 64 MB), it becomes 8 MB:
    texts are long, and a batch is held several times on both sides of a Python worker.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, "8m")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(os.path.dirname(here))
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "ledgersieve_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.write(os.path.join(os.path.dirname(here), "__init__.py"), "ledgersieve/__init__.py")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                full = os.path.join(here, name)
                archive.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where a local master names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="llm-")
    return _own[app]


def written(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a folder of its own under the shared one and read it back.

    Every call has its own folder, so no run meets another run's rows, and a lost
    executor loses nothing that was written.
    """
    spark = df.sparkSession
    path = f"{shared(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that this process holds but no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """``run``, for ``mapInArrow``, that releases its memory at the end of a task.

    A Python worker waits for later tasks, and its allocators would keep most of what the largest
    task so far took, beside whatever the executor's other work needs.
    """
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def ascii_lower(column):
    """A-Z to a-z, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key():
    """64 bits that tell texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


#: Entries of the table that tells which rows a join may touch, at any size of input.
BUCKETS = 1 << 20


def parted(rows: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may meet a ``key`` of ``marks``, and those that can't.

    Keys are told apart by their bucket; the table of marked buckets has at most
    ``BUCKETS`` numbers (8 MB) and is broadcast for that.  So an exact join with few
    marks shuffles few texts, and with many marks no more than all of them.
    """
    bucket = F.pmod("key", F.lit(BUCKETS)).cast("int").alias("bucket")
    marked = F.broadcast(marks.select(bucket).distinct())
    rows = rows.withColumn("bucket", bucket)
    return rows.join(marked, "bucket", "left_semi").drop("bucket"), rows.join(marked, "bucket", "left_anti").drop("bucket")


def without(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose (doc_id, text) is not in ``flagged`` (doc_id, key)."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    flagged = written(flagged.select("doc_id", "key"), "flagged")
    maybe, never = parted(rows, flagged)
    gone = flagged.select(F.col("doc_id").alias("g_id"), F.col("key").alias("g_key"))
    left = maybe.join(gone, maybe["doc_id"].eqNullSafe(gone["g_id"]) & (maybe["key"] == gone["g_key"]), "left_anti")
    return never.unionByName(left).select("row.*")
