"""Column types of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(38, 2)

GRID = T.StructType([
    T.StructField("source_file", T.StringType(), False),
    T.StructField("source_sheet", T.StringType(), False),
    T.StructField("row_no", T.LongType(), False),
    T.StructField("cells", T.ArrayType(T.StringType()), False),
])

TRANSACTIONS = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("txn_seq", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("description", T.StringType()),
    T.StructField("description_clean", T.StringType()),
    T.StructField("vendor_normalized", T.StringType()),
    T.StructField("debit", MONEY),
    T.StructField("credit", MONEY),
    T.StructField("amount_signed", T.DecimalType(19, 2)),
    T.StructField("operation_type", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("bank", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_sheet", T.StringType()),
    T.StructField("source_row", T.LongType()),
])

TXN_LINK = T.StructType([
    T.StructField("grp", T.StringType()),
    T.StructField("txn_id", T.StringType()),
])

FINDINGS = T.StructType([
    T.StructField("alert_seq", T.LongType()),
    T.StructField("alert_id", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("vendor", T.StringType()),
    T.StructField("amount", TOTAL),
    T.StructField("amount_type", T.StringType()),
    T.StructField("date_1", T.DateType()),
    T.StructField("date_2", T.DateType()),
    T.StructField("anchor_date", T.DateType()),
    T.StructField("bank", T.StringType()),
    T.StructField("operation_type", T.StringType()),
    T.StructField("source_loc", T.StringType()),
    T.StructField("evidence", T.StringType()),
    T.StructField("txn_ids", T.StringType()),
    T.StructField("next_step", T.StringType()),
    T.StructField("risk", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("txns", T.ArrayType(TXN_LINK)),
])

BALANCES = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("balance", MONEY),
    T.StructField("ref", T.StringType()),
])
