"""Physical plans and the whole run from grids to published tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgersieve.operators import quality as Q, screening as S
from ledgersieve.plans.consolidate import consolidate, publish
from ledgersieve.sources import fixtures as V
from ledgersieve.sources.staging import stage

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


@pytest.mark.parametrize("rule", [S.round_amounts, S.split_payments, S.high_velocity, S.vendor_growth])
def test_lists_are_cut_before_the_shuffle(spark, rule):
    """Each "first n" list limits a group in the map tasks, so no group is moved whole."""
    plan = plan_of(rule(V.transactions(spark, SF_DIR)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(S.high_velocity(V.transactions(spark, SF_DIR)))
    assert "GreaterThan(debit,20000.00)" in plan
    assert "description" not in plan.split("ReadSchema: ")[1].split("\n")[0].replace("description_clean", "")


def test_publish(spark, tmp_path):
    grid = stage(spark, "plan-grid", lambda: V.statement_grid(spark, SF_DIR))
    run = consolidate(spark, grid, "plan")
    with pytest.raises(Q.ValidationError):  # GAMMA has a row with both sides filled
        publish(spark, run, str(tmp_path / "strict"), "plan", strict=True)
    paths = publish(spark, run, str(tmp_path / "out"), "plan")
    read = lambda t: spark.read.parquet(paths[t])
    assert read("transactions").count() == run.transactions.count()
    assert read("findings").count() > 0 and read("evidence").filter("txn_date IS NULL").count() == 0
    assert {r.status for r in read("dashboard_check").select("status").distinct().collect()} == {"OK"}
    assert read("reconciliation").filter(F.col("metric").startswith("Reconciles")).count() == 3
    assert read("rejected_files").count() == 1
    months = read("transactions").select("month").distinct().count()
    assert months == run.transactions.select(F.date_format("date", "yyyy-MM")).distinct().count()


def test_runs_of_one_name_do_not_meet(spark):
    """Two grids, and two configurations, under the same name."""
    from dataclasses import replace

    from ledgersieve import config as C
    from ledgersieve.plans.consolidate import screened

    def grid(text):
        rows = [("A_x.csv", "Sheet1", n + 1, cells) for n, cells in enumerate(
            [["Date", "Description", "Debit", "Credit"], ["2024-01-02", text, "150", None], ["2024-01-06", text, "150", None]])]
        return spark.createDataFrame(rows, "source_file string, source_sheet string, row_no bigint, cells array<string>")

    one, two = (consolidate(spark, grid(t), "june").transactions for t in ("Alpha goods", "Beta goods"))
    assert {r.description for r in two.collect()} == {"Beta goods"} and {r.description for r in one.collect()} == {"Alpha goods"}
    wide = replace(C.DEFAULT, duplicate=replace(C.DEFAULT.duplicate, max_days_apart=5))
    found = [screened(spark, one, "june", c)[0].filter("category = 'Duplicate Payment'").count() for c in (C.DEFAULT, wide)]
    assert found == [0, 1]
