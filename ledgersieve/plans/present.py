"""Presentation of results: plain types that any client reads the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def plain(df: DataFrame) -> DataFrame:
    """Money as DOUBLE, whole numbers as BIGINT, dates as ISO text."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def plain_alerts(alerts: DataFrame) -> DataFrame:
    """Draft or numbered alerts with the linked transactions as text, without sort keys."""
    links = F.array_join(F.transform("txns", lambda t: F.concat(t["grp"], F.lit(":"), t["txn_id"])), ", ")
    keys = [c for c in alerts.columns if c.startswith("k_") or c == "rule_no"]
    return plain(alerts.withColumn("links", links).drop("txns", *keys))


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Ratios (DOUBLE columns) rounded, so that the last bits of a division do not matter."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])
