import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import findings, frame, row, transactions, written
from ledgersieve import config as C
from ledgersieve.operators import analytics as A, findings as R, quality as Q, tables as K
from ledgersieve.operators import screening as S
from ledgersieve.sources import fixtures as V

BALANCE = "source_file string, balance decimal(18,2), ref string"


def opening(spark, *amounts):
    return spark.createDataFrame([(f"f{i}", Decimal(a), "r") for i, a in enumerate(amounts)], BALANCE)


@pytest.mark.parametrize("n,rows", [(49, 0), (50, 9)])
def test_benford_needs_fifty(spark, n, rows):
    table = transactions(spark, [row("2024-01-02", "Zeta", "0.50")] + [row("2024-01-02", "Zeta", 20 + i % 9) for i in range(n - 1)])
    got = {r.first_digit: r for r in A.benford(table).collect()}
    assert len(got) == rows and A.benford_test(table).count() == (1 if rows else 0)
    if rows:
        # the amount below one counts in the sample, not for any digit
        assert got[2].observed == 49 and got[2].actual_pct == pytest.approx(98) and got[2].note == "Review"
        assert got[1].expected_pct == pytest.approx(100 * math.log10(2))
        chi = sum((r.observed - math.log10(1 + 1 / d) * 50) ** 2 / (math.log10(1 + 1 / d) * 50) for d, r in got.items())
        test = A.benford_test(table).first()
        assert test.chi_square == pytest.approx(chi) and test.passes is False


def test_cash_flow_and_runway(spark):
    one_day = transactions(spark, [row("2024-01-02", "Zeta", 5), row("2024-01-02", "Zeta", credit=7)])
    flat = A.cash_position(one_day, opening(spark)).first()
    assert (flat.net_cash_flow, flat.period_days, flat.avg_daily_burn, flat.ending_balance, flat.runway_days) == \
        (2, None, None, None, None)
    burning = transactions(spark, [row("2024-01-02", "Zeta", 300), row("2024-01-12", "Zeta", credit=100)])
    for start, ending, runway, comment in (
            ("1000", 800, 40.0, "Days until funds depleted (at current burn rate)"), ("300", 100, 5.0, "URGENT - Less than 1 month of cash remaining"),
            ("200", 0, 0.0, "No runway - account at or below zero"), ("50", -150, 0.0, "No runway - account at or below zero"),
            ("9200", 9000, 450.0, "Healthy cash runway")):
        got = A.cash_position(burning, opening(spark, start)).first()
        assert (got.ending_balance, got.runway_days, got.runway_comment) == (ending, pytest.approx(runway), comment)
    assert got.estimated_runway_days == pytest.approx(10.0)
    earning = transactions(spark, [row("2024-01-02", "Zeta", 1), row("2024-01-12", "Zeta", credit=100)])
    assert A.cash_position(earning, opening(spark, "5", "6")).first().runway_days is None


def test_months_and_categories(spark):
    table = transactions(spark, [
        row("2024-01-02", "Zeta", 5), row("2024-02-02", "Zeta", credit=5), row("2024-04-02", "Zeta", 1),
        row("2024-05-02", "Zeta", 1), row("2024-05-03", "payroll", "3.00")])
    trend = [(r.month, r.trend) for r in A.monthly_trend(table).orderBy("month").collect()]
    assert trend == [("2024-01", "—"), ("2024-02", "↑ Improving"), ("2024-04", "↓ Worsening"), ("2024-05", "↓ Worsening")]
    shares = {r.category: (r.amount, r.share) for r in A.category_outflows(table).collect()}
    assert shares == {"Other": (7, pytest.approx(0.7)), "Payroll & Benefits": (3, pytest.approx(0.3))}
    assert A.business_profile(table).first().average_debit == pytest.approx(2.5)
    assert A.totals_agree(table, A.cash_flow(table)).first().validation_error is False


@pytest.mark.parametrize("vendors,rest", [(10, 0), (11, 1)])
def test_concentration(spark, vendors, rest):
    table = transactions(spark, [row("2024-01-02", f"Vendor {chr(65 + i)}", 10) for i in range(vendors)])
    got = A.vendor_concentration(table).collect()
    assert len(got) == 10 + rest
    assert sum(r.percentage for r in got) == pytest.approx(100)
    assert [r.risk_level for r in got if r.vendor == C.OTHER_VENDORS] == ["N/A"] * rest


def test_concentration_bands(spark):
    amounts = {"A": 26, "B": 25, "C": 16, "D": 15, "E": 10, "F": 8}
    table = transactions(spark, [row("2024-01-02", f"Vendor {k}", v) for k, v in amounts.items()])
    got = {r.vendor: r.risk_level for r in A.vendor_concentration(table).collect()}
    assert [got[f"VENDOR {k}"] for k in "ABCDEF"] == ["HIGH", "MEDIUM", "MEDIUM", "MODERATE", "LOW", "LOW"]
    nothing = transactions(spark, [row("2024-01-02", "Zeta", credit=1)])
    assert A.vendor_concentration(nothing).count() == 0


def test_reconciliation(spark):
    table = transactions(spark, [row("2024-01-02", "Zeta", 5, bank=b) for b in "ABC"])
    def of(**values):
        return spark.createDataFrame([(f"{k}_s.csv", Decimal(v), "r") for k, v in values.items()], BALANCE)
    got = {r.source_file: (r.delta, r.reconciles)
           for r in Q.reconciliation(table, of(A="10", B="10"), of(A="5", B="5.01", C="1")).collect()}
    assert got == {"A_s.csv": (0, "TRUE"), "B_s.csv": (Decimal("0.01"), "FALSE"), "C_s.csv": (None, "N/A")}


def some_findings(spark):
    rows = [row("2024-01-03", "Consulting Co", 500), row("2024-01-04", "Consulting Co", 501),
            row("2024-01-03", "Misc", 800), row("2024-01-04", "Misc", 800)]
    rows += [row("2024-02-05", "Zeta", 6000 + i) for i in range(4)]
    table = transactions(spark, rows)
    return table, findings(spark, table)


def test_findings_reports(spark):
    table, found = some_findings(spark)
    assert {r.priority: r.alerts for r in R.priority_counts(found).collect()} == {"P1": 2, "P2": 1, "P3": 0}
    coverage = {r.rule: r.alerts for r in R.rule_coverage(found).collect()}
    assert coverage["Duplicate Payment"] == 2 and coverage["High Velocity Outflows"] == 0 and len(coverage) == 7
    amounts = R.flagged_amounts(found, table).first()
    assert amounts.flagged_amount == 500 + 800 + 24006 and amounts.growth_delta == 0
    index = R.evidence_index(found, table).collect()
    assert len(index) == 4 + 4 and all(r.txn_date is not None for r in index)
    listed = R.alerts_table(found).collect()
    assert [r.priority for r in listed] == ["P1", "P1", "P2"]
    empty = found.limit(0)
    assert R.flagged_amounts(empty, table).first().flagged_pct == 0.0
    assert sum(r.alerts for r in R.rule_coverage(empty).collect()) == 0


def test_split_evidence_is_whole(spark):
    """The evidence lists every payment of a split, also beyond the ids shown in the alert."""
    table = transactions(spark, [row("2024-02-05", "Zeta", 6000 + i) for i in range(9)])
    rule = C.SplitRule(listed_ids=2)
    config = C.ScreeningConfig(split=rule)
    drafts = written(spark, lambda: S.draft_alerts(table, config))
    found = written(spark, lambda: S.number_alerts(drafts))
    assert found.filter("category = 'Split Payments'").first().txn_ids == "TXN_00001, TXN_00002 (+7 more)"
    assert R.evidence_index(found, table).filter("category = 'Split Payments'").count() == 9


def test_a_large_split_lists_all_ids(spark):
    """A vendor-day above 1,000 payments: every id is in the alert, and every id is checked."""
    table = transactions(spark, [row("2024-02-05", "Zeta", 6000 + i) for i in range(1200)])
    drafts = written(spark, lambda: S.draft_alerts(table))
    found = written(spark, lambda: S.number_alerts(drafts))
    (one,) = found.filter("category = 'Split Payments'").collect()
    ids = [r.txn_id for r in table.orderBy("txn_seq").collect()]
    assert one.txn_ids == ", ".join(ids) and [t.txn_id for t in one.txns] == ids
    assert one.source_loc.endswith("(+1197 more)")
    unknown = Q.unknown_references(table.filter(F.col("txn_id") != ids[-1]), found.filter("category = 'Split Payments'"))
    assert [r.detail for r in unknown.collect()] == [ids[-1]]


def test_checks(spark):
    table, found = some_findings(spark)
    clean = Q.all_issues(table, found)
    assert clean.count() == 0 and Q.enforce(clean, strict=True) == 0
    broken = table.withColumn("debit", F.when(F.col("txn_seq") == 1, -F.col("debit")).otherwise(F.col("debit")))
    issues = written(spark, lambda: Q.all_issues(broken, found))
    assert Q.enforce(issues) == 1
    with pytest.raises(Q.ValidationError):
        Q.enforce(issues, strict=True)
    bad = {r.check_name for r in Q.duplicate_issues(table, V.damaged_findings(found)).collect()}
    assert bad == {"duplicate tolerance not named", "duplicate days differ", "duplicate days too far"}
    unknown = found.withColumn("txns", F.expr("transform(txns, t -> named_struct('grp', t.grp, 'txn_id', 'TXN_9'))"))
    assert {r.check_name for r in Q.duplicate_issues(table, unknown).collect()} == {"duplicate id unknown"}
    assert Q.unknown_references(table, unknown).count() == 4 + 4
    nothing = Q.transaction_issues(table.limit(0)).collect()
    assert [r.check_name for r in nothing] == ["empty transactions"]


def test_metric_comparison(spark):
    kind = "section string, key string, metric string, value double"
    published = spark.createDataFrame([
        ("Vendor Concentration", "v", "% of Total", 0.5), ("Benford", "1", "Actual % (Debit)", 30.0),
        ("Cash Flow Metrics", "Total Transactions", "Value", 5.0), ("Monthly Trends", "2024-01", "Net", 1.0)], kind)
    again = spark.createDataFrame([
        ("Vendor Concentration", "v", "% of Total", 0.502), ("Benford", "1", "Actual % (Debit)", 30.1),
        ("Cash Flow Metrics", "Total Transactions", "Value", 5.0), ("Monthly Trends", "2024-02", "Net", 1.0)], kind)
    got = {(r.section, r.key): r.status for r in Q.compare_metrics(published, again).collect()}
    assert got == {("Vendor Concentration", "v"): "MISMATCH", ("Benford", "1"): "OK",
                   ("Cash Flow Metrics", "Total Transactions"): "OK",
                   ("Monthly Trends", "2024-01"): "N/A", ("Monthly Trends", "2024-02"): "N/A"}


def test_configuration_tables(spark):
    table = transactions(spark, [row("2024-01-02", "Zeta", 5)])
    stats = S.run_statistics(table)
    assert K.threshold_table(stats).count() == 8 and K.exclusion_table(spark).count() == 5
    values = {r.parameter: r.value for r in K.run_calculations(stats).collect()}
    assert values == {"p95_debit (outflows)": "N/A (n<=20)", "weekend_threshold": "25000.00",
                      "weekend_threshold_floor": "25000"}


def test_links_hold_every_payment_of_an_alert(spark):
    from collections import defaultdict

    import brute
    from test_rules import skewed

    table = transactions(spark, skewed(5, 700), partitions=3)
    plain = [r for r in frame(table) if r["debit"] is not None and r["debit"] > 0]
    found = findings(spark, table)
    links = defaultdict(dict)
    for r in R.alert_links(found, table).collect():
        assert (r["grp"], r["txn_id"]) not in links[r["alert_id"]]
        links[r["alert_id"]][r["grp"], r["txn_id"]] = r["listed"]
    names = {n: i for i, n in enumerate(C.RULE_NAMES, 1)}
    seen = set()
    for alert in found.collect():
        rule, got = names[alert["category"]], links[alert["alert_id"]]
        seen.add(rule)
        listed = {(t["grp"], t["txn_id"]) for t in alert["txns"]}
        assert {k for k, shown in got.items() if shown} == listed
        month = lambda r: r["date"].replace(day=1)
        expected = {
            3: lambda: {("Related", r["txn_id"]) for r in plain if r["debit"] == alert["amount"] and not brute.says(r["description_clean"], C.FIXED_COST_WORDS)},
            4: lambda: {("Related", r["txn_id"]) for r in plain if r["date"] == alert["date_1"] and brute.key(r) == alert["vendor"]},
            7: lambda: {("Related", r["txn_id"]) for r in plain if r["date"] == alert["date_1"] and r["debit"] > 20000},
            8: lambda: {(g, r["txn_id"]) for g, d in (("Baseline", "date_1"), ("Latest", "date_2")) for r in plain
                        if brute.key(r) == alert["vendor"] and month(r) == alert[d] and r["operation_type"] not in C.GROWTH_EXCLUDED_CATEGORIES},
        }.get(rule, lambda: listed)
        if rule == 6:
            assert len(got) == int(alert["vendor"].split()[0]) and all(r["debit"] > 25000 for r in plain if ("Related", r["txn_id"]) in got)
        else:
            assert set(got) == expected(), alert["category"]
    assert {1, 3, 4, 6, 7} <= seen


@pytest.mark.parametrize("rows", [0, 3, 400])
def test_the_recomputation_equals_the_dashboard_and_shows_damage(spark, rows):
    from test_rules import skewed

    table = transactions(spark, skewed(6, rows), partitions=3) if rows else transactions(spark, [row("2024-01-01", "x", debit=1)]).limit(0)
    opening = spark.createDataFrame([("A_s.csv", Decimal("10.50"), "x")], "source_file string, balance decimal(18,2), ref string")
    published = written(spark, lambda: Q.dashboard_metrics(table, opening))
    again = Q.recomputed_metrics(table, opening)
    status = {(r["section"], r["key"], r["metric"]): r["status"] for r in Q.compare_metrics(published, again).collect()}
    assert len(status) == published.count()
    assert set(status.values()) <= {"OK", "N/A"} and ("N/A" not in status.values() or rows < 50)
    if rows == 400:
        damaged = published.withColumn("value", F.when(F.col("section") == "Monthly Trends", F.col("value") + 1).otherwise(F.col("value")))
        bad = Q.compare_metrics(damaged, again).where("status = 'MISMATCH'").select("section").distinct().collect()
        assert [r["section"] for r in bad] == ["Monthly Trends"]
