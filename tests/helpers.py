"""Small transactions tables for tests."""

from __future__ import annotations

import datetime as dt
import itertools
from decimal import Decimal

from ledgersieve.operators.numbering import transaction_ids
from ledgersieve.schema import TRANSACTIONS
from ledgersieve.operators.screening import draft_alerts, number_alerts
from ledgersieve.sources.intake import enriched
from ledgersieve.sources.staging import stage

_number = itertools.count()


def written(spark, build):
    """Write a table and read it back, as the plans do between their steps."""
    return stage(spark, f"test-{next(_number)}", build)

SOURCE = ("date date, description string, debit decimal(18,2), credit decimal(18,2), bank string, "
          "source_file string, source_sheet string, source_row bigint")


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def row(date, description, debit=None, credit=None, bank="A", source_row=None, operation_type=None):
    return dict(
        date=day(date) if isinstance(date, str) else date, description=description,
        debit=None if debit is None else Decimal(str(debit)), credit=None if credit is None else Decimal(str(credit)),
        bank=bank, source_row=source_row, operation_type=operation_type)


def transactions(spark, rows, partitions=None):
    """Canonical transactions; ``operation_type`` of a row overrides the classifier."""
    data = [
        (r["date"], r["description"], r["debit"], r["credit"], r["bank"], f"{r['bank']}_s.csv", "Sheet1",
         r["source_row"] or i)
        for i, r in enumerate(rows, 2)]
    frame = spark.createDataFrame(data, SOURCE)
    if partitions:
        frame = frame.repartition(partitions)
    named = enriched(frame)
    forced = [(f"{r['bank']}_s.csv", r["source_row"] or i, r["operation_type"])
              for i, r in enumerate(rows, 2) if r["operation_type"]]
    if forced:
        over = spark.createDataFrame(forced, "source_file string, source_row bigint, forced string")
        named = (named.join(over, ["source_file", "source_row"], "left")
                 .selectExpr("*", "coalesce(forced, operation_type) AS op")
                 .drop("forced", "operation_type").withColumnRenamed("op", "operation_type"))
    rows_table = written(spark, lambda: named)
    return written(spark, lambda: transaction_ids(rows_table).select(*TRANSACTIONS.fieldNames()))


def findings(spark, table):
    drafts = written(spark, lambda: draft_alerts(table))
    return written(spark, lambda: number_alerts(drafts))


def frame(table):
    """A transactions table as a list of dicts in id order, for brute-force checks."""
    return [r.asDict() for r in table.orderBy("txn_seq").collect()]
