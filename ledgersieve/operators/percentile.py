"""Exact percentile with linear interpolation, without gathering the values in one task.

A mergeable quantile sketch gives two values that lie on either side of the wanted rank.
The values below and between them are counted exactly, and a sketch is taken again of
those between, until few are left.  A round leaves a share of the values that depends on
the sketch's accuracy alone, not on how amounts are spread; a value that repeats counts
as one.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

#: Ranks of the sketch are wrong by 1 / ``ACCURACY`` of the values at most.
ACCURACY = 1000
#: Values that are placed in one task.
FEW = 20_000


def bracket(values: DataFrame, n: int, low: int, high: int, few: int = FEW, accuracy: int = ACCURACY) -> tuple:
    """(least, largest, below): ranks ``low`` to ``high``, from 0, of the ``n`` values ``v`` lie between the first two.

    ``below`` values are smaller than ``least``; about ``few`` lie strictly between.  Every
    bracket is checked by exact counts, so a sketch that errs only costs a round.
    """
    least, largest = values.agg(F.min("v"), F.max("v")).first()
    inside, below, open_ = n, 0, n
    while open_ > few and least < largest:
        between = values.where(F.col("v").between(F.lit(least), F.lit(largest)))
        slack = 2 * math.ceil(inside / accuracy)
        shares = [max(0.0, (low - below - slack) / inside), min(1.0, (high - below + 1 + slack) / inside)]
        a, b = between.agg(F.percentile_approx("v", shares, accuracy)).first()[0]
        v = F.col("v")
        under, n_inside, n_open = between.agg(
            F.count_if(v < F.lit(a)), F.count_if(v.between(F.lit(a), F.lit(b))), F.count_if((v > F.lit(a)) & (v < F.lit(b)))).first()
        if not below + under <= low <= high < below + under + n_inside or n_open >= open_:
            break
        least, largest, inside, below, open_ = a, b, n_inside, below + under, n_open
    return least, largest, below


def exact_percentile(values: DataFrame, column: str, fraction: str, few: int = FEW) -> DataFrame:
    """One row ``(n, percentile)`` over the values of ``column`` that are not null."""
    spark = values.sparkSession
    v = values.select(F.col(column).alias("v")).where("v is not null")
    n = v.count()
    if not n:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("decimal(24,6)").alias("percentile"))
    rank = (n - 1) * Decimal(fraction)
    low, high = math.floor(rank), math.ceil(rank)
    least, largest, below = bracket(v, n, low, high, few)
    counts = v.where(F.col("v").between(F.lit(least), F.lit(largest))).groupBy("v").agg(F.count(F.lit(1)).alias("k"))
    upto = below + F.sum("k").over(Window.partitionBy(F.lit(0)).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    holds = lambda i: (F.lit(i) >= F.col("upto") - F.col("k")) & (F.lit(i) < F.col("upto"))
    picked = counts.withColumn("upto", upto).agg(
        F.max(F.when(holds(low), F.col("v"))).alias("low"), F.max(F.when(holds(high), F.col("v"))).alias("high"))
    part = F.lit(rank - low).cast("decimal(5,4)")
    return picked.select(
        F.lit(n).cast("bigint").alias("n"),
        (F.col("low") + (F.col("high") - F.col("low")) * part).cast("decimal(24,6)").alias("percentile"))
