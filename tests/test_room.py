"""What queries write and shuffle: files that nothing reads any more go, few rows are looked for once."""

import datetime as dt
import glob
import time

from pyspark.sql import functions as F

from ledgersieve.functions import text as X
from ledgersieve.operators import findings as R, quality as Q, screening as S
from ledgersieve.plans.consolidate import consolidate
from ledgersieve.sources import fixtures as V, grid as G
from ledgersieve.sources.sinks import Run
from ledgersieve.sources.staging import CLEANUP, settled, shared_folder, short, stage

PAYMENTS = "txn_id string, txn_seq bigint, date date, description_clean string, vendor_normalized string, debit decimal(18,2), " \
           "credit decimal(18,2), operation_type string, bank string, source_file string, source_sheet string, source_row bigint"


def payments(spark):
    from decimal import Decimal
    rows = [(f"TXN_{i:05d}", i, dt.date(2024, 1, 1) + dt.timedelta(days=i % 60), f"goods {i}", f"VENDOR {i % 3}", Decimal(1000 * (i % 9 + 1)),
             None, "Other", "A", "A_x.csv", "Sheet1", i + 1) for i in range(1, 400)]
    return settled(spark, spark.createDataFrame(rows, PAYMENTS), "room-payments")


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(10_000).repartition(7).groupBy((F.col("id") % 100).alias("k")).count()
    before, kept = shuffle_files(spark), spark.conf.get(CLEANUP)
    settled(spark, rows, "room")
    stage(spark, f"room-{tmp_path.name}", lambda: rows)
    Run(spark, str(tmp_path)).write("findings", rows)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP) == kept


def test_written_tables_are_packed(spark):
    settled(spark, spark.range(10), "room-packed")
    folder = shared_folder(spark).removeprefix("file://")
    assert glob.glob(f"{folder}/ledgersieve/*/room-packed-*/*.zstd.parquet")


def test_rules_look_for_few_payments_once(spark):
    rows = payments(spark)
    table = rows.inputFiles()[0].rsplit("/", 1)[0]
    few = [S.round_amounts(rows), S.weekend_collapsed(rows)]
    assert few[0].count() == 9
    for found in few:
        assert not [f for f in found.inputFiles() if f.startswith(table)]


def test_a_short_list_is_sent_to_the_payments(spark):
    rows = payments(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        looked_up = R.named_only(rows, rows.where("txn_seq < 5"))
        plan = looked_up._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and looked_up.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_long_list_is_not_sent(spark, monkeypatch):
    rows = payments(spark)
    monkeypatch.setattr("ledgersieve.sources.staging.SHORT", 3)
    assert "broadcast" not in short(rows)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in short(settled(spark, rows.limit(3), "room-three"))._jdf.queryExecution().analyzed().toString()


def test_links_name_their_alert(spark):
    """An alert's id and category come with its keys, not by a join of all links."""
    rows = payments(spark)
    found = settled(spark, S.screen(rows), "room-found")
    links = R.alert_links(found, rows)
    names = {(r.alert_seq, r.alert_id, r.category) for r in found.collect()}
    assert {(r.alert_seq, r.alert_id, r.category) for r in links.collect()} == names
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join Inner, (alert_seq" in line]


def test_only_lines_of_longer_records_are_brought_together(spark, tmp_path):
    (tmp_path / "A_x.csv").write_text('a,1\n"b\nc",2\nd,3\n"e"\n"f,4\n')
    lines = settled(spark, G._known(G.statement_lines(spark, str(tmp_path)).withColumn("_id", F.monotonically_increasing_id()), ","), "room-lines")
    found = G.joined_records(lines)
    assert [(r.row_no, r.value, r.lines, r.is_open) for r in found.orderBy("row_no").collect()] == [
        (1, "a,1", 1, False), (2, '"b\nc",2', 2, False), (3, "d,3", 1, False), (4, '"e"', 1, False), (5, '"f,4', 1, True)]
    assert found._jdf.queryExecution().analyzed().children().size() == 3


def test_reconciliation_writes_no_transactions(spark):
    cells = [["Date", "Description", "Debit", "Credit"], ["2024-01-02", "Alpha goods", "150", None], ["2024-01-03", "ACH PAYMENT - Freight Co", None, "7"]]
    grid = spark.createDataFrame([("A_x.csv", "Sheet1", n, c) for n, c in enumerate(cells, 1)], "source_file string, source_sheet string, row_no bigint, cells array<string>")
    run = consolidate(spark, grid, "room")
    found = Q.reconciliation(run.described, run.opening, run.closing).collect()
    assert [(str(r.inflow), str(r.outflow), r.transactions) for r in found] == [("7.00", "150.00", 2)]
    assert "_transactions" not in vars(run)
    lazy, whole = run.described, run.transactions
    assert lazy.dtypes == whole.dtypes and lazy.exceptAll(whole).isEmpty() and whole.exceptAll(lazy).isEmpty()
    assert run.described.inputFiles() == whole.inputFiles()


def test_a_date_is_prepared_once(spark):
    """The bare day stands once in the plan, not once a format."""
    frame = spark.createDataFrame([("a",)], "t string")
    plan = frame.select(X.parse_date(F.col("t")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 1


def test_line_items_are_not_shuffled_to_meet_suppliers(spark, tmp_path):
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    day = dt.datetime(1996, 3, 1)
    put("lineitem", [(1, 1, 7, 2, 150.0, day), (1, 2, 7, 9, 10.0, day), (2, 1, 7, None, 10.0, day)],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_shipdate timestamp")
    put("supplier", [(2, "Supplier#2"), (2, "Supplier#2b"), (None, "Supplier#x")], "s_suppkey bigint, s_name string")
    put("orders", [], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_totalprice double")
    put("customer", [], "c_custkey bigint, c_name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = V.movements(spark, str(tmp_path))
        payments = rows._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
        assert "rightHint=(strategy=broadcast)" in payments
        assert sorted(r.description for r in rows.collect()) == ["WIRE OUT - Wholesale Trader 2, Inc INV 1", "WIRE OUT - Wholesale Trader 2b, Inc INV 1"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
