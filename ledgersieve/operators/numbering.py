"""Global dense numbering without a global window.

A plain ``row_number()`` over the whole table would run in one task.  Here the
order is split into levels, coarse to fine (for example day, file, block of
rows).  Rows per finest group are counted with partial aggregation, the counts
are turned into offsets on small tables, and only the position *inside* one
finest group needs a window over rows.  The caller picks the levels so that a
finest group is bounded, whatever a single day, file or vendor holds.

Where no such levels are known, rows are dealt to ranges of the whole order, whose
borders Spark samples, sorted inside them and written.  Ranges hold about as many rows
each, however often a value repeats, and only their sizes and first rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgersieve.sources.staging import settled

# Rows of one file and day that are numbered together.
ROW_BLOCK = 1_000_000


def group_offsets(
    counts: DataFrame, levels: Sequence[Sequence[str]], within: Sequence[str] = (), n: str = "n"
) -> DataFrame:
    """Number of rows ahead of each finest group, from one row with count ``n`` per group.

    Every level is summed up on its own before its running total, so a window
    partition only holds the distinct values of one level inside one parent group:
    the days of the table, the files of a day, the blocks of a file.
    """
    parent = list(within)
    keys = [*parent, *[c for level in levels for c in level]]
    offsets, ahead = counts, F.lit(0)
    for depth, level in enumerate(levels):
        before = (
            Window.partitionBy(*parent).orderBy(*level)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        parent = [*parent, *level]
        name = f"_ahead{depth}"
        if depth == len(levels) - 1:
            offsets = offsets.withColumn(name, F.sum(n).over(before))
        else:
            totals = counts.groupBy(*parent).agg(F.sum(n).alias("_n"))
            offsets = offsets.join(
                totals.select(*parent, F.sum("_n").over(before).alias(name)), parent)
        ahead = ahead + F.coalesce(F.col(name), F.lit(0))
    return offsets.select(*keys, ahead.cast("bigint").alias("_offset"))


def dense_sequence(
    rows: DataFrame,
    levels: Sequence[Sequence[str]],
    order: Sequence[str | Column],
    out: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Number rows 1, 2, 3 … by ``levels`` then ``order``, restarting for each ``within``.

    Level columns must not be null.  The result depends on the data alone, so a
    recomputed task gives the same numbers.
    """
    keys = [*within, *[c for level in levels for c in level]]
    # The null filter is the one the joins imply; stated here, every use of the
    # counts has the same plan and Spark computes it once.
    counts = rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    offsets = group_offsets(counts, levels, within)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        rows.withColumn("_pos", position)
        .join(offsets, keys)
        .withColumn(out, F.col("_offset") + F.col("_pos"))
        .drop("_offset", "_pos")
    )


def transaction_ids(rows: DataFrame) -> DataFrame:
    """Add ``txn_seq`` and ``txn_id`` in the order date, file, sheet, row."""
    block = F.floor(F.col("source_row") / ROW_BLOCK)
    return (
        dense_sequence(
            rows.withColumn("_block", block),
            levels=[["date"], ["source_file", "source_sheet"], ["_block"]],
            order=["source_row"],
            out="txn_seq",
        )
        .drop("_block")
        .withColumn("txn_id", F.format_string("TXN_%05d", "txn_seq"))
    )


def ensure_transaction_ids(rows: DataFrame) -> DataFrame:
    """Add ids only where the table has none."""
    return rows if "txn_id" in rows.columns else transaction_ids(rows)


# A written row's id is its range above these bits, and its place in the range below.
PLACE_BITS = 33


def ranges(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` in ranges of ``order``, sorted and written, with ``_range`` and ``_place`` (from 0).

    Ids of a range rise with the order, and ranges are numbered by it; both are fixed by
    the written table, so lost executors or other samples can't change them.  Rows that
    ``order`` does not tell apart may lie on both sides of a border.
    """
    spark = rows.sparkSession
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    dealt = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    placed = settled(spark, dealt.withColumn("_id", F.monotonically_increasing_id()), label)
    return placed.withColumns({
        "_range": F.shiftright("_id", PLACE_BITS), "_place": F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1)}).drop("_id")


def ranged_sequence(rows: DataFrame, order: Sequence[str], out: str, label: str) -> DataFrame:
    """Number rows 1, 2, 3 … by ``order``, nulls first, in one shuffle; only a row per range is added up."""
    placed = ranges(rows, order, label)
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    offsets = settled(rows.sparkSession, group_offsets(counts, [["_range"]]), f"{label}-offsets")
    return placed.join(offsets, "_range").withColumn(out, F.col("_offset") + F.col("_place") + 1).drop("_offset", "_range", "_place")


def with_next(rows: DataFrame, order: Sequence[str], columns: Sequence[str], label: str) -> DataFrame:
    """Add ``next_…`` of the row that follows in ``order`` over the whole table; null for the last.

    Neighbours are looked up inside each range, and the first row of a range is handed to
    the one before it.  No key has a task of its own, so none is hot.
    """
    placed = ranges(rows, order, label)
    firsts = placed.where("_place = 0").select("_range", F.struct(*columns).alias("_first"))
    handed = settled(rows.sparkSession, firsts.select(
        "_range", F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy("_range")).alias("_handed")), f"{label}-borders")
    inside = Window.partitionBy("_range").orderBy("_place")
    found = placed.join(handed, "_range").withColumn("_next", F.coalesce(F.lead(F.struct(*columns)).over(inside), F.col("_handed")))
    return found.select(*rows.columns, *[F.col("_next")[c].alias(f"next_{c}") for c in columns])
