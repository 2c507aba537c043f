"""Configuration tables published with the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgersieve import config as C

_TABLE = "line int, rule string, threshold string, rationale string, source string"


def threshold_table(stats: DataFrame) -> DataFrame:
    """Static rule thresholds and, from the run statistics, the run-specific ones."""
    spark = stats.sparkSession
    static = spark.createDataFrame([(i, *row) for i, row in enumerate(C.THRESHOLD_TABLE, 1)], _TABLE)
    two = lambda c: F.round(c, 2).cast("decimal(24,2)").cast("string")
    start = len(C.THRESHOLD_TABLE)
    items = F.array(
        F.struct(F.lit(start + 1).alias("line"), F.lit("RUN-SPECIFIC: p95_debit").alias("rule"),
                 two("p95_debit").alias("threshold"),
                 F.lit("95th percentile of debit amounts").alias("rationale"),
                 F.lit("Computed from Transactions").alias("source")),
        F.struct(F.lit(start + 2).alias("line"), F.lit("RUN-SPECIFIC: weekend_threshold").alias("rule"),
                 two("weekend_threshold").alias("threshold"),
                 F.lit("Weekend debit alert threshold").alias("rationale"),
                 F.lit("Computed from Transactions").alias("source")))
    return static.unionByName(stats.select(F.explode(items).alias("i")).select("i.*"))


def exclusion_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(C.EXCLUSION_TABLE, 1)]
    return spark.createDataFrame(rows, "line int, rule string, excluded_categories string, rationale string")


def run_calculations(stats: DataFrame, rule: C.WeekendRule = C.DEFAULT.weekend) -> DataFrame:
    """The run-specific numbers with the way to verify them."""
    n = F.concat(F.lit("n="), F.col("weekend_outflow_txn_count").cast("string"))
    two = lambda c: F.round(c, 2).cast("decimal(24,2)").cast("string")
    row = lambda p, v, how, note: F.struct(
        F.lit(p).alias("parameter"), v.alias("value"), F.lit(how).alias("how_to_verify"), note.alias("notes"))
    items = F.array(
        row("p95_debit (outflows)", F.coalesce(two("p95_debit"), F.lit(f"N/A (n<={rule.percentile_above_rows})")),
            "Quantile(0.95) of Debit > 0 in Transactions", n),
        row("weekend_threshold", two("weekend_threshold"), f"max({rule.floor}, p95_debit) if n>{rule.percentile_above_rows} else {rule.floor}", F.lit("")),
        row("weekend_threshold_floor", F.col("weekend_threshold_floor").cast("int").cast("string"),
            "Hard floor used in weekend rule", F.lit("")))
    return stats.select(F.explode(items).alias("i")).select("i.*")
