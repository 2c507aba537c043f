"""Reconciliation, integrity checks and published-versus-recomputed comparison.

Checks return issues ``(check_name, severity, alert_id, detail, n)``; an empty result
means nothing was found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgersieve import config as C
from ledgersieve.functions.text import concentration_vendor, money_text, month_text
from ledgersieve.operators import analytics as A
from ledgersieve.operators.findings import listed_links, named_only
from ledgersieve.schema import TOTAL
from ledgersieve.sources.staging import settled

ISSUE_COLUMNS = ("check_name", "severity", "alert_id", "detail", "n")


class ValidationError(Exception):
    """Integrity checks failed in strict mode."""


# --- reconciliation -------------------------------------------------------------

def reconciliation(transactions: DataFrame, opening: DataFrame, closing: DataFrame) -> DataFrame:
    """Per file: period, totals, reported and expected balances and whether they agree."""
    zero = F.lit(0).cast(TOTAL)
    total = lambda c: F.coalesce(F.sum(c), zero).cast(TOTAL)
    files = transactions.groupBy("source_file").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("transactions"),
        total("credit").alias("inflow"), total("debit").alias("outflow"), total("amount_signed").alias("net"))
    named = lambda b, p: b.select(
        "source_file", F.col("balance").alias(p), F.col("ref").alias(f"{p}_ref"))
    delta = F.col("closing") - F.col("expected")
    return (
        files.join(named(opening, "opening"), "source_file", "left")
        .join(named(closing, "closing"), "source_file", "left")
        .withColumn("expected", (F.col("opening") + F.col("net")).cast(TOTAL))
        .withColumn("delta", delta.cast(TOTAL))
        .withColumn("reconciles", F.when(F.col("delta").isNull(), "N/A")
                    .when(F.abs("delta") < 0.01, "TRUE").otherwise("FALSE"))
    )


def reconciliation_rows(reconciled: DataFrame) -> DataFrame:
    """The reconciliation as ten labelled rows per file."""
    as_text = lambda c: F.col(c).cast("string")
    ref = lambda c: F.coalesce(F.col(c), F.lit("N/A"))
    # The labels of the rows as published.
    derived, source = F.lit("Derived"), F.lit("Transactions")
    period = F.coalesce(F.concat_ws(" — ", as_text("first_date"), as_text("last_date")), F.lit("N/A"))
    rows = [
        ("Statement period (from Transactions)", period, source),
        ("Transactions count", as_text("transactions"), source),
        ("Total inflows (Credit)", as_text("inflow"), source),
        ("Total outflows (Debit)", as_text("outflow"), source),
        ("Net cash flow (Credit - Debit)", as_text("net"), source),
        ("Opening balance (reported)", as_text("opening"), ref("opening_ref")),
        ("Closing balance (reported)", as_text("closing"), ref("closing_ref")),
        ("Closing balance (expected)", as_text("expected"), derived),
        ("Delta (reported - expected)", as_text("delta"), derived),
        ("Reconciles (abs(delta)<0.01)", F.col("reconciles"), derived),
    ]
    items = F.array(*[
        F.struct(F.lit(i).alias("line"), F.lit(m).alias("metric"), v.alias("value"), r.alias("ref"))
        for i, (m, v, r) in enumerate(rows, 1)])
    return reconciled.select("source_file", F.explode(items).alias("i")).select("source_file", "i.*")


# --- integrity of the transactions -----------------------------------------------

def transaction_figures() -> dict[str, Column]:
    """Aggregates of transactions that their checks need, but for repeated ids."""
    debit, credit = F.coalesce("debit", F.lit(0)), F.coalesce("credit", F.lit(0))
    direction = F.lower(F.coalesce("direction", F.lit("")))
    blank = F.coalesce(F.trim("txn_id"), F.lit("")) == ""
    return {
        "rows": F.count(F.lit(1)), "no_id": F.count_if(blank), "negative": F.count_if((debit < 0) | (credit < 0)),
        "both": F.count_if((debit > 0) & (credit > 0)), "bad_out": F.count_if((debit > 0) & ~direction.contains("out")),
        "bad_in": F.count_if((credit > 0) & ~direction.contains("in")), "no_date": F.count_if(F.col("date").isNull())}


def transaction_issues(transactions: DataFrame, figures: dict | None = None) -> DataFrame:
    """Ids, signs, sides, direction and dates in one pass (ids in their own aggregate).

    ``figures`` are :func:`transaction_figures` as observed while the table was written;
    then only the ids are read again.
    """
    if figures is None:
        counted = transactions.agg(*[c.alias(name) for name, c in transaction_figures().items()])
    else:
        counted = transactions.sparkSession.range(1).select(*[F.lit(figures[name]).cast("bigint").alias(name) for name in transaction_figures()])
    repeated = (
        transactions.groupBy(F.coalesce("txn_id", F.lit("")).alias("id"))
        .agg((F.count(F.lit(1)) - 1).alias("extra")).agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n")).scalar()
    )
    checks = [
        ("empty transactions", "error", F.when(F.col("rows") == 0, 1).otherwise(0)),
        ("missing txn id", "error", F.col("no_id")),
        ("txn id not unique", "error", F.col("repeated")),
        ("negative debit or credit", "error", F.col("negative")),
        ("debit and credit both filled", "error", F.col("both")),
        ("direction of a debit", "warning", F.col("bad_out")),
        ("direction of a credit", "warning", F.col("bad_in")),
        ("date missing", "warning", F.col("no_date")),
    ]
    items = F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.lit(s).alias("severity"), F.lit(None).cast("string").alias("alert_id"),
                 F.lit(None).cast("string").alias("detail"), n.cast("bigint").alias("n"))
        for c, s, n in checks])
    return (
        counted.withColumn("repeated", repeated).select(F.explode(items).alias("i")).select("i.*")
        .filter(F.col("n") > 0)
    )


# --- integrity of the findings ----------------------------------------------------

def _issue(rows: DataFrame, check: str, severity: str, detail: Column, bad: Column | None = None) -> DataFrame:
    kept = rows if bad is None else rows.filter(bad)
    return kept.select(
        F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), "alert_id",
        detail.cast("string").alias("detail"), F.lit(1).cast("bigint").alias("n"))


def _issues(rows: DataFrame, severity: str, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Several predicates over the same rows in one pass: ``{check: (is bad, detail)}``."""
    items = F.array(*[
        F.when(bad, F.struct(F.lit(check).alias("check_name"), detail.cast("string").alias("detail")))
        for check, (bad, detail) in checks.items()])
    return (
        rows.select("alert_id", F.explode(F.filter(items, lambda i: i.isNotNull())).alias("i"))
        .select("i.check_name", F.lit(severity).alias("severity"), "alert_id", "i.detail",
                F.lit(1).cast("bigint").alias("n"))
    )


def unknown_references(transactions: DataFrame, findings: DataFrame) -> DataFrame:
    """Ids named by a finding that no transaction has."""
    named = listed_links(findings)
    missing = named.join(named_only(transactions.select("txn_id"), named), "txn_id", "left_anti")
    return _issue(missing, "unknown txn id", "error", F.col("txn_id"))


def growth_issues(transactions: DataFrame, findings: DataFrame) -> DataFrame:
    """Growth alerts: months named in the evidence, both groups filled, ids in their month."""
    target = findings.filter(F.col("category") == C.RULE_NAMES[7])
    base, late = month_text(F.col("date_1")), month_text(F.col("date_2"))
    ids = lambda group: F.filter("txns", lambda t: t["grp"] == group)
    named = lambda month: F.coalesce(F.col("evidence").contains(month), F.lit(False))
    segment = lambda group: F.regexp_extract("txn_ids", group + r" (\d{4}-\d{2})", 1)
    differs = lambda group, month: (segment(group) != "") & (segment(group) != month)
    no_dates = F.col("date_1").isNull() | F.col("date_2").isNull()
    whole = _issues(target, "warning", {
        "growth dates missing": (no_dates, F.lit(None)),
        "growth evidence months": (~no_dates & ~(named(base) & named(late)), F.concat_ws(" & ", base, late)),
        "growth baseline segment month": (differs("Baseline", base), segment("Baseline")),
        "growth latest segment month": (differs("Latest", late), segment("Latest")),
        "growth baseline ids missing": (F.size(ids("Baseline")) == 0, F.lit(None)),
        "growth latest ids missing": (F.size(ids("Latest")) == 0, F.lit(None)),
    })
    known = named_only(transactions.select("txn_id", "date"), listed_links(target))
    months = known.select("txn_id", month_text(F.col("date")).alias("month"))
    single = (
        target.filter(~no_dates)
        .select("alert_id", base.alias("base"), late.alias("late"), F.explode("txns").alias("t"))
        .select("alert_id", "t.grp", "t.txn_id",
                F.when(F.col("t.grp") == "Baseline", F.col("base")).otherwise(F.col("late")).alias("wanted"))
        .join(months, "txn_id", "left")
    )
    each = _issues(single, "warning", {
        "growth id unknown": (F.col("month").isNull(), F.col("txn_id")),
        "growth id in other month": (F.col("month") != F.col("wanted"), F.concat_ws(" ", "txn_id", "month")),
    })
    return whole.unionByName(each)


def duplicate_issues(
    transactions: DataFrame, findings: DataFrame, max_days: int = C.DEFAULT.duplicate.max_days_apart
) -> DataFrame:
    """Duplicate alerts: two known ids, both amounts and the tolerance named, days right."""
    target = findings.filter(F.col("category") == C.RULE_NAMES[0])
    known = named_only(transactions.select("txn_id", "debit"), listed_links(target))
    amounts = known.withColumn("known", F.lit(True))
    found = (
        target.select("alert_id", "evidence", "date_1", "date_2", F.size("txns").alias("ids"),
                      F.explode_outer("txns").alias("t"))
        .select("*", F.col("t.txn_id").alias("txn_id")).drop("t").join(amounts, "txn_id", "left")
    )
    has_amount = F.col("evidence").contains(money_text(F.coalesce("debit", F.lit(0).cast("decimal(18,2)"))))
    folded = found.groupBy("alert_id").agg(
        F.first("evidence").alias("evidence"), F.first("ids").alias("ids"),
        F.abs(F.datediff(F.first("date_1"), F.first("date_2"))).alias("days"),
        F.count_if(F.col("known").isNull()).alias("unknown"), F.count_if(~has_amount).alias("unnamed"))
    pair = (F.col("ids") == 2) & (F.col("unknown") == 0)
    stated = F.regexp_extract("evidence", r"(\d+)\s*day\(s\)\s*apart", 1).try_cast("int")
    return _issues(folded, "warning", {
        "duplicate not two ids": (F.col("ids") != 2, F.col("ids")),
        "duplicate id unknown": ((F.col("ids") == 2) & (F.col("unknown") > 0), F.col("unknown")),
        "duplicate amounts not named": (pair & (F.col("unnamed") > 0), F.col("evidence")),
        "duplicate tolerance not named": (
            pair & ~F.lower("evidence").contains("tolerance"), F.col("evidence")),
        "duplicate days differ": (pair & (stated != F.col("days")), F.concat_ws(" ", stated, "days")),
        "duplicate days too far": (pair & (F.col("days") > max_days), F.col("days")),
    })


def all_issues(
    transactions: DataFrame, findings: DataFrame, config: C.ScreeningConfig = C.DEFAULT, figures: dict | None = None,
) -> DataFrame:
    """All checks, by the settings that the findings were made with; ``figures`` as for :func:`transaction_issues`."""
    parts = [
        transaction_issues(transactions, figures), unknown_references(transactions, findings),
        growth_issues(transactions, findings), duplicate_issues(transactions, findings, config.duplicate.max_days_apart),
    ]
    return reduce(DataFrame.unionByName, parts)


def enforce(issues: DataFrame, strict: bool = False) -> int:
    """Number of issues that count as errors; in strict mode any of them stops the run.

    Strict mode takes the findings checks (reported as warnings) as errors too,
    but not the direction and date warnings.  Only one row reaches the driver.
    """
    tolerated = ("direction of a debit", "direction of a credit", "date missing")
    counted = issues.agg(
        F.coalesce(F.sum(F.when(F.col("severity") == "error", F.col("n"))), F.lit(0)).alias("errors"),
        F.count_if(~F.col("check_name").isin(*tolerated)).alias("failing")).first()
    if strict and counted["failing"] > 0:
        raise ValidationError(f"{counted['failing']} integrity checks failed")
    return counted["errors"]


# --- published against recomputed ---------------------------------------------------

# Accepted difference per section and metric.
TOLERANCES = (
    ("Cash Flow Metrics", "Total Transactions", 0.0),
    ("Cash Flow Metrics", "Beginning Balance", 0.01),
    ("Cash Flow Metrics", "Ending Balance", 0.01),
    ("Cash Flow Metrics", "Total Inflows", 0.01),
    ("Cash Flow Metrics", "Total Outflows", 0.01),
    ("Cash Flow Metrics", "Net Cash Flow", 0.01),
    ("Cash Flow Metrics", "Avg Daily Inflow", 0.02),
    ("Cash Flow Metrics", "Avg Daily Outflow", 0.02),
    ("Cash Flow Metrics", "Daily Burn Rate", 0.02),
)
SECTION_TOLERANCES = (
    ("Monthly Trends", "Inflows", 0.01), ("Monthly Trends", "Outflows", 0.01), ("Monthly Trends", "Net", 0.01),
    ("Benford", "Actual % (Debit)", 0.2),
    ("Vendor Concentration", "Total Spending", 0.01), ("Vendor Concentration", "% of Total", 0.001),
    ("Category Outflows", "Amount", 0.01), ("Category Inflows", "Amount", 0.01),
)


def _tolerance() -> Column:
    value = F.when(F.lit(False), F.lit(0.0))
    for section, key, tol in TOLERANCES:
        value = value.when((F.col("section") == section) & (F.col("key") == key), F.lit(tol))
    for section, metric, tol in SECTION_TOLERANCES:
        value = value.when((F.col("section") == section) & (F.col("metric") == metric), F.lit(tol))
    return value.otherwise(F.lit(0.01))


def _long(rows: DataFrame, section: str, key: Column, metrics: dict[str, Column]) -> DataFrame:
    items = F.array(*[
        F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()])
    return rows.select(F.lit(section).alias("section"), key.cast("string").alias("key"), F.explode(items).alias("i")) \
        .select("section", "key", "i.metric", "i.value")


def dashboard_metrics(transactions: DataFrame, opening: DataFrame) -> DataFrame:
    """Every published figure as ``(section, key, metric, value)``, rounded as shown."""
    cash = A.cash_position(transactions, opening)
    two = lambda c: F.bround(c, 2)
    cash_keys = {
        "Total Transactions": F.col("transaction_count"), "Beginning Balance": F.col("beginning_balance"),
        "Ending Balance": F.col("ending_balance"), "Total Inflows": F.col("total_inflow"),
        "Total Outflows": F.col("total_outflow"), "Net Cash Flow": F.col("net_cash_flow"),
        "Avg Daily Inflow": two("avg_daily_inflow"), "Avg Daily Outflow": two("avg_daily_outflow"),
        "Daily Burn Rate": two("avg_daily_burn"),
    }
    items = F.array(*[
        F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in cash_keys.items()])
    cash_rows = cash.select(F.explode(items).alias("i")).select(
        F.lit("Cash Flow Metrics").alias("section"), "i.key", F.lit("Value").alias("metric"), "i.value")
    parts = [
        cash_rows,
        _long(A.monthly_totals(transactions), "Monthly Trends", F.col("month"), {
            "Inflows": F.col("inflows"), "Outflows": F.col("outflows"), "Net": F.col("net")}),
        _long(A.benford(transactions), "Benford", F.col("first_digit"), {
            "Actual % (Debit)": F.bround("actual_pct", 1)}),
        _long(A.vendor_concentration(transactions), "Vendor Concentration", F.col("vendor"), {
            "Total Spending": F.col("total_spending"), "% of Total": F.bround(F.col("percentage") / 100, 3)}),
        _long(A.category_outflows(transactions), "Category Outflows", F.col("category"), {"Amount": F.col("amount")}),
        _long(A.category_inflows(transactions), "Category Inflows", F.col("category"), {"Amount": F.col("amount")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def recomputed_metrics(transactions: DataFrame, opening: DataFrame, label: str = "recomputed") -> DataFrame:
    """The figures of :func:`dashboard_metrics` again, by other means.

    One aggregation with grouping sets reads the transactions once, for all figures:
    by month, by direction and category, by first digit, by vendor, and over all.  It is
    written, and every figure follows from its few rows; no formula is shared with the
    dashboard's, so an error in one of them shows.
    """
    paid = F.col("debit") > 0
    digits = F.ltrim(F.translate(F.format_number(F.col("debit"), 2), ",.", ""), F.lit("0"))
    rows = transactions.select(
        F.date_format("date", "yyyy-MM").alias("month"), "direction", F.col("operation_type").alias("category"), "date", "debit", "credit",
        F.when(paid, F.when(F.col("debit") < 1, F.lit("0")).otherwise(F.left(digits, F.lit(1)))).alias("digit"),
        concentration_vendor(transactions.columns).alias("vendor"))
    sets = [["month"], ["direction", "category"], ["digit"], ["vendor"], []]
    keys = ["month", "direction", "category", "digit", "vendor"]
    summed = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(
        F.grouping_id(*keys).alias("g"), F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("debit"), F.lit(0)).alias("out"), F.coalesce(F.sum("credit"), F.lit(0)).alias("into"),
        F.min("date").alias("first"), F.max("date").alias("last"))
    summed = settled(transactions.sparkSession, summed, label)
    # A set's number has a bit for each key that it leaves out.
    number = lambda s: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s)
    months, categories, by_digit, vendors, total = (summed.where(F.col("g") == number(s)) for s in sets)

    def listed(rows: DataFrame, section: str, key: Column, metric: str, value: Column) -> DataFrame:
        return rows.select(F.lit(section).alias("section"), key.cast("string").alias("key"), F.lit(metric).alias("metric"), value.cast("double").alias("value"))

    start = opening.agg(F.sum("balance").alias("b")).scalar()
    days = F.datediff("last", "first")
    a_day = lambda x: F.when(days > 0, F.bround(x.cast("double") / days, 2))
    net = F.col("into") - F.col("out")
    cash = {
        "Total Transactions": F.col("n"), "Beginning Balance": start, "Ending Balance": start + net, "Total Inflows": F.col("into"),
        "Total Outflows": F.col("out"), "Net Cash Flow": net, "Avg Daily Inflow": a_day(F.col("into")), "Avg Daily Outflow": a_day(F.col("out")),
        "Daily Burn Rate": a_day(F.col("out") - F.col("into"))}
    parts = [listed(total, "Cash Flow Metrics", F.lit(k), "Value", v) for k, v in cash.items()]
    dated = months.where("month is not null")
    parts += [listed(dated, "Monthly Trends", F.col("month"), m, F.col(c) if c else net) for m, c in (("Inflows", "into"), ("Outflows", "out"), ("Net", None))]
    counted = by_digit.where("digit is not null")
    every = counted.agg(F.sum("n").alias("n")).scalar()
    enough = every >= C.BENFORD_MIN_ROWS
    nine = transactions.sparkSession.range(1, 10).select(F.col("id").cast("string").alias("d"))
    share = nine.join(counted, F.col("d") == F.col("digit"), "left").where(enough)
    parts.append(listed(share, "Benford", F.col("d"), "Actual % (Debit)", F.bround(F.coalesce("n", F.lit(0)) * 100 / every, 1)))
    whole = vendors.agg(F.sum("out").alias("s")).scalar()
    first = vendors.where(whole > 0).orderBy(F.desc("out"), "vendor").limit(C.CONCENTRATION_TOP)
    top = settled(transactions.sparkSession, first.select("vendor", F.col("out").alias("spent")), f"{label}-top")
    others = vendors.join(top.select("vendor"), "vendor", "left_anti").agg(F.sum("out").alias("spent")).where(F.col("spent") > 0)
    rest = others.select(F.lit(C.OTHER_VENDORS).alias("vendor"), "spent")
    both = top.unionByName(rest)
    parts.append(listed(both, "Vendor Concentration", F.col("vendor"), "Total Spending", F.col("spent")))
    parts.append(listed(both, "Vendor Concentration", F.col("vendor"), "% of Total", F.bround(F.col("spent").cast("double") / whole.cast("double"), 3)))
    parts.append(listed(categories.where("direction = 'Outflow'"), "Category Outflows", F.col("category"), "Amount", F.col("out")))
    parts.append(listed(categories.where("direction = 'Inflow'"), "Category Inflows", F.col("category"), "Amount", F.col("into")))
    return reduce(DataFrame.unionByName, parts)


def compare_metrics(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Full outer comparison with a tolerance per metric: OK, MISMATCH or N/A."""
    keys = ["section", "key", "metric"]
    both = published.withColumnRenamed("value", "published").join(
        recomputed.withColumnRenamed("value", "recomputed"), keys, "full_outer")
    return (
        both.withColumn("delta", F.col("published") - F.col("recomputed"))
        .withColumn("status", F.when(F.col("delta").isNull(), "N/A")
                    .when(F.abs("delta") <= _tolerance(), "OK").otherwise("MISMATCH"))
    )
