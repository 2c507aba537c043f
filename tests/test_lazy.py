"""Steps that a query does not read are not made, and conditions stay small enough to be compiled."""

import datetime as dt
import glob
import re

from pyspark.sql import functions as F

from ledgersieve.functions import classify as K, text as X
from ledgersieve.plans import registry as R
from ledgersieve.plans.consolidate import consolidate, screened
from ledgersieve.sources import fixtures as V, grid as G
from ledgersieve.sources.intake import enriched
from ledgersieve.sources.staging import is_staged, shared_folder

GRID = "source_file string, source_sheet string, row_no bigint, cells array<string>"


def statement(spark):
    cells = [["Date", "Description", "Debit", "Credit"], ["2024-01-02", "Alpha goods", "150", None],
             ["soon", "x", "1", None], ["2024-01-03", "ACH PAYMENT - Freight Co", None, "7"]]
    return spark.createDataFrame([("A_x.csv", "Sheet1", n, c) for n, c in enumerate(cells, 1)], GRID)


def test_rejects_and_balances_need_no_transactions(spark):
    run = consolidate(spark, statement(spark), "lazy")
    assert {(r.reason, r.lost) for r in run.rejects.collect()} == {("above the table", 1), ("unread date", 1)}
    assert run.opening.count() == 0 and run.closing.count() == 0
    assert "_transactions" not in vars(run)
    assert "vendor_normalized" not in run.lines.columns
    assert [(r.txn_seq, r.vendor_normalized, r.operation_type) for r in run.transactions.orderBy("txn_seq").collect()] == [
        (1, "ALPHA GOODS", "Other"), (2, "FREIGHT", "Shipping & Logistics")]
    assert run.transaction_figures["rows"] == 2


def test_entries_are_the_transactions(spark):
    sf_dir = "/root/testdata/sf0.001"
    whole, narrow = V.transactions(spark, sf_dir), R.entries(spark, sf_dir)
    assert narrow.columns == [c for c in whole.columns if c not in V.DESCRIBED]
    same = whole.select(*narrow.columns)
    assert narrow.count() == same.count() and narrow.exceptAll(same).isEmpty()


def test_totals_are_taken_from_rows_without_numbers(spark):
    sf_dir = "/root/testdata/sf0.001"
    whole, plain = R.entries(spark, sf_dir), V.unnumbered(spark, sf_dir)
    same = whole.select(*plain.columns)
    assert set(whole.columns) - set(plain.columns) == {"txn_id", "txn_seq", "source_row"}
    assert plain.count() == same.count() and plain.exceptAll(same).isEmpty()
    for name in ("monthly_totals", "merged_layouts"):
        plan = R.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem" in R.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan


def tables(spark, folder):
    """Line items, orders, suppliers and customers of a few weeks; some prices are whole thousands, those of a Saturday large."""
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    day = lambda i: dt.datetime(1996, 3, 1) + dt.timedelta(days=i % 40)
    price = lambda i: 400000.0 + i if i % 40 == 1 else 20000.0 + 700 * i if i % 4 else 3000.0
    put("lineitem", [(i // 3, i % 3 + 1, i % 50, i % 7, price(i), day(i)) for i in range(200)],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_shipdate timestamp")
    put("supplier", [(i, f"Supplier#{i:05d}") for i in range(7)], "s_suppkey bigint, s_name string")
    put("orders", [(i, i % 5, day(i), 500.0 * i) for i in range(70)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_totalprice double")
    put("customer", [(i, f"Customer#{i:05d}") for i in range(5)], "c_custkey bigint, c_name string")
    return str(folder)


def test_rules_on_few_rows_write_no_described_transactions(spark, tmp_path):
    sf_dir = tables(spark, tmp_path)
    names = ("round_amounts", "weekend_few", "weekend_single", "weekend_collapsed")
    found = {name: sorted(map(str, R.queries()[name](spark, sf_dir).collect())) for name in names}
    assert found["round_amounts"] and found["weekend_collapsed"]
    assert not is_staged(spark, V.transactions_name(sf_dir, "actual"))
    lazy = V.described(spark, sf_dir)
    whole = V.transactions(spark, sf_dir)
    assert lazy.columns == whole.columns and whole.count() == 270 and lazy.exceptAll(whole).isEmpty() and whole.exceptAll(lazy).isEmpty()
    # With the written transactions at hand the rules read those, and say the same.
    assert {name: sorted(map(str, R.queries()[name](spark, sf_dir).collect())) for name in names} == found


def test_a_rule_prepares_what_it_needs(spark, tmp_path):
    sf_dir = tables(spark, tmp_path)
    R.queries()["new_counterparties"](spark, sf_dir).collect()
    built = {name for app, name in R._runs if app == spark.sparkContext.applicationId and name.startswith(f"actual-{R._slug(sf_dir)}")}
    assert {name.rsplit("-", 1)[1] for name in built} == {"firsts"}


def test_findings_are_written_once_in_their_order(spark, tmp_path):
    rows = V.transactions(spark, tables(spark, tmp_path))
    found, _ = screened(spark, rows, "once-only")
    numbers = [r.alert_seq for r in found.orderBy("alert_seq").collect()]
    assert numbers and numbers == list(range(1, len(numbers) + 1))
    folder = shared_folder(spark).removeprefix("file://")
    assert glob.glob(f"{folder}/ledgersieve/*/once-only-drafts*") and not glob.glob(f"{folder}/ledgersieve/*/once-only-findings*")


def test_a_description_is_prepared_once(spark):
    """The text a category is looked up in stands once in the plan, not once a category."""
    frame = spark.createDataFrame([("a",)], "description string")
    plan = frame.select(K.keyword_category(F.col("description")).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1


def test_enriching_fits_the_compiler(spark):
    frame = spark.range(1).select(
        F.lit("x").alias("description"), *[F.lit(None).cast("decimal(18,2)").alias(c) for c in ("debit", "credit")])
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    try:
        spark.conf.set("spark.sql.codegen.wholeStage", "true"), spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        shown = enriched(frame.repartition(1))._jdf.queryExecution().explainString(mode)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all(int(n) < 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", shown))


def test_spaces(spark):
    texts = ["", " ", "a b", "a  b", "a\tb", "a\r\nb", "a b", "a  b", "é  é", "a \n", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        X.collapse_spaces(F.col("t")).alias("c"), X.plain_spaces(F.col("t")).alias("p"), "t").collect()
    for r in got:
        if r.t is not None:
            assert r.c == re.sub(r"[ \t\n\x0b\f\r]{2,}|[\t\n\x0b\f\r]", " ", r.t)
            assert r.p == r.t.replace(" ", " ").replace(" ", " ")
        else:
            assert r.c is None and r.p is None


def test_phrases_meet_any_white_space(spark):
    texts = ["federal \t tax", "irs\n", "irs", "xups", "ups ", "supplies  12", "AMAZON x Office", "rubio", " a rubio b"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in frame.select("i", K.keyword_category(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got == ["Taxes & Government", "Taxes & Government", "Other", "Shipping & Logistics", "Shipping & Logistics",
                   "Office & Supplies", "Office & Supplies", "Owner Transactions", "Owner Transactions"]


def test_first_sheet_of_a_file_with_a_fixed_name(spark):
    one = spark.createDataFrame([("A.csv", "S1", 1, ["x"]), ("A.csv", "S2", 1, ["y"])], GRID)
    two = spark.range(2).select(F.lit("B.csv").alias("source_file"), F.lit("S1").alias("source_sheet"), "id", F.array(F.lit("z")).alias("cells"))
    sheets = spark.createDataFrame([("A.csv", "S1", 2), ("A.csv", "S2", 1), ("B.csv", "S1", 1)], "source_file string, source_sheet string, position int")
    found = G.first_sheet(one.unionByName(two.withColumnRenamed("id", "row_no")), sheets)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.source_file, r.source_sheet) for r in found.collect()) == [("A.csv", "S2"), ("B.csv", "S1"), ("B.csv", "S1")]
