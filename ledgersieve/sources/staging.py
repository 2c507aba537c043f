"""Written tables in the shared folder the session names.

Intermediate tables that many jobs read are written once and read back.  That
cuts the lineage, survives the loss of executors, gives later scans column
pruning and filter push-down, and gives the planner exact sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_local_folder: str | None = None

#: Written tables take about half the room of Spark's default at the same speed.
CODEC = "zstd"
#: Lets Spark delete a query's shuffle files when the query ends, not when the driver forgets it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a written table that are sent to all tasks; a longer one is joined as its size says.
SHORT = 500_000


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only on a local master."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="ledgersieve-")
    return _local_folder


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/ledgersieve/{spark.sparkContext.applicationId}/{name}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: later steps read the written table."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _put(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).option("compression", CODEC).parquet(path)


def short(written: DataFrame) -> DataFrame:
    """A written table, to be sent to all tasks if its rows, which its files count, are few."""
    return F.broadcast(written) if written.count() <= SHORT else written


_staged: dict[tuple[str, str], str] = {}


def stage(spark: SparkSession, name: str, build) -> DataFrame:
    """Write ``build()`` under ``name`` once per application and read it back.

    Only for inputs that a name fully describes (a scale, a calendar).  A run over a
    grid or with settings of its own uses :func:`settled`, which never meets another
    run's table.
    """
    key = (spark.sparkContext.applicationId, name)
    if key not in _staged:
        path = table_path(spark, name)
        _put(build(), path, "overwrite")
        _staged[key] = path
    return spark.read.parquet(_staged[key])


def is_staged(spark: SparkSession, name: str) -> bool:
    """Whether this application has written the table ``name`` already."""
    return (spark.sparkContext.applicationId, name) in _staged


def settled(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a result under a name of its own and read it back; nothing is remembered."""
    path = table_path(spark, f"{label}-{uuid.uuid4().hex}")
    _put(df, path)
    return spark.read.parquet(path)


def observed(spark: SparkSession, df: DataFrame, label: str, figures: dict[str, Column]) -> tuple[DataFrame, dict]:
    """Like :func:`settled`, with aggregates of the rows that are taken while they are written."""
    seen = Observation()
    kept = settled(spark, df.observe(seen, *[c.alias(name) for name, c in figures.items()]), label)
    return kept, seen.get
