import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgersieve import config as C
from ledgersieve.functions import text as X


def apply(spark, function, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in frame.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_description(spark):
    cases = {
        "ACH PAYMENT - Acme Corp INV 10484": "Acme Corp",
        "  wire out -   North   Metals  PO5839": "North Metals",
        "CHECK PAID #1020 - Joe": "Joe",
        "Card Purchase 01/02 12:30 Cafe": "Cafe",
        "MISC. CREDIT - refund": "refund",
        "Outward Fast Payments Bolt FP341404": "Bolt",
        "Inward Payments": "Inward Payments",
        "INV 123": "INV 123",
        "Inward Payments INV 12": "INV 12",
        # each prefix is removed once, in the configured order
        "WIRE IN - ACH DEBIT - X": "ACH DEBIT - X",
        "ACH DEBIT - WIRE IN - X": "X",
        "DEBIT CARD - ONLINE PAYMENT - X": "X",
        "tab\tand\nline": "tab and line",
    }
    assert apply(spark, X.clean_description, list(cases)) == list(cases.values())
    assert apply(spark, X.clean_description, [None, "", "   "]) == [None, "", "   "]


def test_normalize_vendor(spark):
    cases = {
        "Acme, Inc.": "ACME",
        "Trader 000000001, Inc": "TRADER 000000001",
        "Bolt Co Limited REF 88": "BOLT",
        "Co-Op Company Store": "COOP STORE",
        "LLC": "LLC",
        "Faster Payments - out Shop": "SHOP",
        "CREDIT CARD - Gym": "GYM",
        "a.b;c:d": "ABCD",
        "-": "",
        "Income Corporation": "INCOME",
        "Big Comet": "BIG COMET",
    }
    assert apply(spark, X.normalize_vendor, list(cases)) == list(cases.values())
    assert apply(spark, X.normalize_vendor, [None, " "]) == [None, " "]


def test_prefixes_in_one_pass_equal_one_after_the_other(spark):
    prefixes = ["ACH CREDIT - ", "WIRE TRANSFER - ", "CHECK PAID #7 - ", "BILL PAYMENT - ", "SERVICE FEE - ",
                "Card Purchase 1/2 3:4 ", "Inward Payments ", "Outward Payments ", "CARD PURCHASE - ",
                "DEBIT CARD - ", "ONLINE PAYMENT - ", "REMOTE DEPOSIT - "]
    values = [a + b + "Shop  7 CP 9" for a in prefixes for b in ["", *prefixes]]

    def one_by_one(v):
        v = v.strip()
        for p in [*C.DESCRIPTION_PREFIXES, C.DESCRIPTION_REFERENCE]:
            v = re.sub(p, "", v, flags=re.IGNORECASE)
        return re.sub(r"\s+", " ", v).strip()

    assert apply(spark, X.clean_description, values) == [one_by_one(v) for v in values]


@pytest.mark.parametrize("text,want", [
    ("2024-01-31", "2024-01-31"), ("2024-01-31 10:20:30", "2024-01-31"), ("2024-1-5", "2024-01-05"),
    ("01/02/2024", "2024-01-02"), ("13/02/2024", "2024-02-13"), ("1/2/24", "2024-01-02"),
    ("31.12.2023", "2023-12-31"), ("5 Mar 2024", "2024-03-05"), ("05-Mar-2024", "2024-03-05"),
    ("Mar 5, 2024", "2024-03-05"), ("2024/03/05", "2024-03-05"), ("2024-02-30", None), ("Total", None),
    ("", None), (None, None), ("12", None),
])
def test_parse_date(spark, text, want):
    assert apply(spark, X.parse_date, [text]) == [None if want is None else dt.date.fromisoformat(want)]


def test_parse_amount(spark):
    got = apply(spark, X.parse_amount, ["1,200.50", "1 200.5", "-7", "0", "text", "nan", "$5.00", "", None, "1.239"])
    d = Decimal
    assert got == [d("1200.50"), d("1200.50"), d("-7.00"), d("0.00"), None, None, None, None, None, d("1.24")]


def test_amount_sides(spark):
    frame = spark.sql("SELECT cast(v AS decimal(18,2)) v FROM VALUES (-5), (7), (0), (null) t(v)")
    got = [tuple(r) for r in frame.select(
        X.zero_to_null(X.outflow_part(F.col("v"))), X.zero_to_null(X.inflow_part(F.col("v")))).collect()]
    assert got == [(Decimal("5.00"), None), (None, Decimal("7.00")), (None, None), (None, None)]


def test_vendor_keys(spark):
    frame = spark.createDataFrame(
        [("V", "d"), (" ", "d"), (None, None), ("", " ")], "vendor_normalized string, description_clean string")
    assert [r[0] for r in frame.select(X.screening_vendor(frame.columns)).collect()] == \
        ["V", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert [r[0] for r in frame.select(X.concentration_vendor(frame.columns)).collect()] == \
        ["V", "d", "UNKNOWN", "UNKNOWN"]
    only = frame.select("description_clean")
    assert [r[0] for r in only.select(X.screening_vendor(only.columns)).collect()][0] == "d"
    assert spark.range(1).select(X.screening_vendor(["id"])).first()[0] == "UNKNOWN"


def test_source_pointer_and_column_letter(spark):
    one = spark.range(1)
    assert one.select(X.source_pointer(F.lit("f"), F.lit("s"), F.lit(3))).first()[0] == "f | s | R3"
    letters = [one.select(X.column_letter(F.lit(i))).first()[0] for i in (0, 25, 26, 27, 52)]
    assert letters == ["A", "Z", "AA", "AB", "BA"]


def test_date_forms(spark):
    forms = ["January 5, 2024", "5 January 2024", "20240105", "2024-01-05T00:00:00Z", "2024-01-05 00:00:00 +00:00",
             "01/05/2024 3:00 PM", "05-Jan-24", "5 Jan 24", "Jan 5 2024", "5 sept 2024", "Sept. 5, 2024", "JAN\u00a05, 2024", "5th May 2024"]
    rows = spark.createDataFrame([(f,) for f in forms], "t string").select(X.parse_date(F.col("t")).cast("string")).collect()
    month = lambda f: "09" if "ept" in f else "05" if "May" in f else "01"
    assert [r[0] for r in rows] == [f"2024-{month(f)}-05" for f in forms]
    none = spark.createDataFrame([("Marble 5, 2024",), ("20241305",), ("5 2024",), ("Total 1 2024",)], "t string")
    assert [r[0] for r in none.select(X.parse_date(F.col("t"))).collect()] == [None] * 4


def test_wide_spaces_are_spaces(spark):
    row = spark.createDataFrame([("ACH\u00a0PAYMENT - ACME\u00a0INC", "ACH PAYMENT - ACME INC")], "a string, b string")
    a, b, c, d = row.select(*(f(F.col(x)) for f in (X.clean_description, X.normalize_vendor) for x in "ab")).first()
    assert a == b and c == d


def test_dates_with_weekdays_and_short_times(spark):
    import datetime as dt

    from ledgersieve.functions.text import parse_date

    texts = ["2024.01.05", "Fri, 5 Jan 2024", "Friday 5 January 2024", "Jan 5, 24", "20240105T101500", "20240105T1015Z", "01/05/24 3pm", "2024-01-05 11 a.m.", "Fri 2024-01-05 10:15"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in frame.select("t", parse_date(F.col("t"))).collect()} == dict.fromkeys(texts, dt.date(2024, 1, 5))
    odd = spark.createDataFrame([("Friday",), ("T1015",), ("3pm",), ("Fri, ",), ("5",)], "t string")
    assert {r[0] for r in odd.select(parse_date(F.col("t"))).collect()} == {None}
