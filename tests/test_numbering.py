import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import row, transactions
from ledgersieve.operators import numbering as N
from ledgersieve.operators.percentile import bracket, exact_percentile


def test_ids_follow_date_file_sheet_row(spark, monkeypatch):
    monkeypatch.setattr(N, "ROW_BLOCK", 7)
    rng = random.Random(1)
    rows = []
    for f in ("B_x.csv", "A_x.csv", "C"):
        for i in range(1, 120):
            hot = rng.random() < 0.4
            rows.append((dt.date(2024, 1, 1) if hot else dt.date(2024, 1, rng.randint(1, 9)), f, f"S{i % 2}", i))
    rng.shuffle(rows)
    kind = "date date, source_file string, source_sheet string, source_row bigint"
    for parts in (1, 5):
        got = N.transaction_ids(spark.createDataFrame(rows, kind).repartition(parts)).collect()
        order = [tuple(r)[:4] for r in sorted(got, key=lambda r: r.txn_seq)]
        assert [(r[0], r[1], r[2], r[3]) for r in order] == sorted(rows)
        assert sorted(r.txn_seq for r in got) == list(range(1, len(rows) + 1))


def test_more_than_five_digits(spark):
    frame = spark.range(100_003).select(
        F.lit(dt.date(2024, 1, 1)).alias("date"), F.lit("f").alias("source_file"), F.lit("s").alias("source_sheet"),
        F.col("id").alias("source_row"))
    got = N.transaction_ids(frame)
    assert got.filter("txn_id = 'TXN_100003'").first().source_row == 100_002
    assert got.filter("txn_id = 'TXN_00001'").first().source_row == 0
    assert got.select("txn_id").distinct().count() == 100_003


def test_ids_only_where_absent(spark):
    frame = transactions(spark, [row("2024-01-01", "x", debit=1)])
    assert N.ensure_transaction_ids(frame) is frame
    assert "txn_id" in N.ensure_transaction_ids(frame.drop("txn_id", "txn_seq")).columns


@pytest.mark.parametrize("size", [1, 2, 20, 21, 500])
def test_percentile_equals_linear_interpolation(spark, size):
    rng = random.Random(size)
    # a third of the values are equal
    cents = [12345 if rng.random() < 0.33 else rng.randint(1, 9_000_000) for _ in range(size)]
    frame = spark.createDataFrame([(c,) for c in cents], "c bigint").select(
        (F.col("c") / 100).cast("decimal(18,2)").alias("v"))
    got = exact_percentile(frame, "v", "0.95").first()
    assert got.n == size
    assert float(got.percentile) == pytest.approx(np.quantile(np.array(cents) / 100, 0.95), abs=1e-6)


def test_percentile_of_nothing(spark):
    got = exact_percentile(spark.createDataFrame([], "v decimal(18,2)"), "v", "0.95").first()
    assert got.n == 0 and got.percentile is None


def _skewed(spark, n=4000):
    """Rows of which a third have one key, and all keys begin alike."""
    rng = random.Random(3)
    rows = [("AAA HOT" if rng.random() < 0.33 else f"AAA {rng.randint(1, 40):02d}", rng.choice([None, *range(60)]), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, v int, id int").repartition(5)


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))


def test_numbers_by_ranges_follow_the_order_and_ranges_are_even(spark):
    rows, frame = _skewed(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        got = N.ranged_sequence(frame, ["k", "v", "id"], "n", "test").collect()
        sizes = [r["count"] for r in N.ranges(frame, ["k", "v", "id"], "test").groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [(r.k, r.v, r.id) for r in sorted(got, key=lambda r: r.n)] == _sorted(rows)
    assert sorted(r.n for r in got) == list(range(1, len(rows) + 1))
    assert len(sizes) >= 12 and max(sizes) < 3 * len(rows) / len(sizes)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_the_next_row_is_found_over_range_borders(spark, parts):
    rows, frame = _skewed(spark, 200)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = N.with_next(frame, ["k", "v", "id"], ["k", "id"], "test").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = _sorted(rows)
    expected = {a[2]: (b[0], b[2]) for a, b in zip(order, order[1:])} | {order[-1][2]: (None, None)}
    assert {r.id: (r.next_k, r.next_id) for r in got} == expected
    assert N.with_next(frame.limit(0), ["k"], ["id"], "test").count() == 0


@pytest.mark.parametrize("spread", ["even", "hot", "two", "wide"])
def test_percentile_by_rounds_of_sketches(spark, spread):
    """So few values in the end that several rounds are needed, with values that repeat."""
    rng = random.Random(spread)
    draw = {
        "even": lambda: rng.randint(1, 900_000), "hot": lambda: 777 if rng.random() < 0.4 else rng.randint(1, 900),
        "two": lambda: rng.choice([100, 10_000]), "wide": lambda: int(10 ** rng.uniform(0, 12))}[spread]
    cents = [draw() for _ in range(6000)]
    frame = spark.createDataFrame([(c,) for c in cents] + [(None,)], "c bigint").select((F.col("c") / 100).cast("decimal(18,2)").alias("v")).repartition(4)
    for fraction in ("0.95", "0.5", "0", "1"):
        got = exact_percentile(frame, "v", fraction, few=10).first()
        assert got.n == 6000
        assert float(got.percentile) == pytest.approx(np.quantile(np.array(cents) / 100, float(fraction)), rel=1e-12, abs=1e-6)


def test_a_bracket_holds_few_values(spark):
    values = spark.range(20_000).selectExpr("cast(id * id as decimal(18,2)) v")
    least, largest, below = bracket(values, 20_000, 18_999, 19_000, few=50, accuracy=100)
    inside = values.where(F.col("v").between(F.lit(least), F.lit(largest))).count()
    assert below <= 18_999 and below + inside > 19_000 and inside <= 60
