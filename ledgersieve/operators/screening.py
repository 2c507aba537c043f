"""The screening rules.  Each maps the transactions table to draft alerts.

A draft has the columns of a finding without its number, plus the sort keys
``rule_no, k_date, k_vendor, k_amount, k_day, k_seq`` that fix the order of the
alert numbers.  Lists inside an alert ("first five ids") come from ``row_number``
with a limit, which Spark applies before the shuffle, so no group is gathered
whole, whatever one vendor, day or amount holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgersieve import config as C
from ledgersieve.functions.text import (
    contains_any, money_text, month_text, screening_vendor, source_pointer,
)
from ledgersieve.operators.numbering import ensure_transaction_ids, ranged_sequence, with_next
from ledgersieve.operators.percentile import exact_percentile
from ledgersieve.schema import FINDINGS, TOTAL
from ledgersieve.sources.staging import settled, short

SORT_KEYS = {
    "rule_no": "int", "k_date": "date", "k_vendor": "string",
    "k_amount": "decimal(18,2)", "k_day": "date", "k_seq": "bigint",
}
_NUMBERED = ("alert_seq", "alert_id")


# --- helpers ---------------------------------------------------------------

def screened(transactions: DataFrame) -> DataFrame:
    """Transactions with ids and the vendor key the rules group by."""
    rows = ensure_transaction_ids(transactions)
    return rows.withColumn("vendor_key", screening_vendor(rows.columns))


def debits(transactions: DataFrame) -> DataFrame:
    return screened(transactions).filter(F.col("debit") > 0)


def _draft(rows: DataFrame, rule_no: int, priority: str, severity: str, **columns) -> DataFrame:
    """Project rows to the draft layout; columns not given are null."""
    values = {
        "rule_no": F.lit(rule_no), "priority": F.lit(priority), "severity": F.lit(severity),
        "category": F.lit(C.RULE_NAMES[rule_no - 1]),
    }
    for name, value in columns.items():
        values[name] = value if isinstance(value, Column) else F.lit(value)
    fields = {f.name: f.dataType for f in FINDINGS if f.name not in _NUMBERED}
    return rows.select(*[
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in {**SORT_KEYS, **fields}.items()
    ])


def _links(ids: Column, group: str = "Related") -> Column:
    return F.transform(ids, lambda t: F.struct(F.lit(group).alias("grp"), t.alias("txn_id")))


def _id_text(ids: Column) -> Column:
    return F.array_join(ids, ", ")


def _field(items: Column, name: str) -> Column:
    return F.transform(items, lambda i: i[name])


def _one_or_multiple(low: str, high: str) -> Column:
    return F.when(F.col(low) == F.col(high), F.col(low)).otherwise(F.lit("Multiple"))


def _first_rows(rows: DataFrame, keys: list[str], order: list, limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, as ``_rank`` 1, 2, …"""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= limit)


def _gathered(rows: DataFrame, keys: list[str], *fields: str) -> DataFrame:
    """``items`` per group in rank order; only for rows that ``_first_rows`` has bounded."""
    return rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_rank", *fields))).alias("items"))


def _percent(share: str) -> str:
    return f"{(Decimal(share) * 100).normalize():f}"


def _thousands(amount: str) -> str:
    """5000.00 as 5k; what is no whole thousand in full."""
    value = Decimal(amount)
    return f"{value / 1000:.0f}k" if value % 1000 == 0 else f"{value.normalize():,f}"


def _pointer() -> Column:
    return source_pointer(F.col("source_file"), F.col("source_sheet"), F.col("source_row"))


# The texts that the rules below give an alert (amount types, evidence, next
# steps, risks, actions) are published wording.

# --- duplicate payments ------------------------------------------------------

def duplicate_pairs(transactions: DataFrame, rule: C.DuplicateRule = C.DEFAULT.duplicate) -> DataFrame:
    """Adjacent payments of a vendor by amount then date, 1..n days apart, nearly equal.

    Rows with the same vendor, amount and day are folded first: inside such a group
    neighbours are zero days apart and never count, so only its first and last row
    matter.  Neighbours are looked up in ranges of the whole order, so a vendor with a
    third of all rows is spread like any other.
    """
    rows = screened(transactions).filter(F.col("debit") >= F.lit(rule.min_amount).cast("decimal(18,2)"))
    if "operation_type" in rows.columns:
        rows = rows.filter(~F.col("operation_type").isin(*rule.excluded_categories))
    groups = (
        rows.withColumn("is_fee", contains_any(F.col("description_clean"), rule.fee_phrases))
        .groupBy("vendor_key", "debit", "date")
        .agg(F.min("txn_seq").alias("first_seq"), F.max("txn_seq").alias("last_seq"),
             F.max_by("is_fee", "txn_seq").alias("is_fee"))
    )
    following = ("debit", "date", "first_seq")
    pairs = with_next(groups, ["vendor_key", "debit", "date"], ["vendor_key", *following], "payments")
    pairs = pairs.filter(F.col("next_vendor_key") == F.col("vendor_key"))
    columns = ["vendor_key", "debit", "date", "last_seq", "is_fee", *[f"next_{c}" for c in following]]
    days = F.abs(F.datediff("next_date", "date"))
    near = (F.col("next_debit") - F.col("debit")) < F.col("debit") * F.lit(rule.amount_tolerance).cast("decimal(6,4)")
    return (
        pairs.select(*columns).withColumn("days_apart", days)
        .filter(near & (F.col("days_apart") >= 1) & (F.col("days_apart") <= rule.max_days_apart) & ~F.col("is_fee"))
        .select(
            "vendor_key", "days_apart",
            F.col("last_seq").alias("seq_1"), F.col("debit").alias("debit_1"), F.col("date").alias("date_1"),
            F.col("next_first_seq").alias("seq_2"), F.col("next_debit").alias("debit_2"),
            F.col("next_date").alias("date_2"))
    )


def duplicate_payments(
    transactions: DataFrame, rule: C.DuplicateRule = C.DEFAULT.duplicate, pairs: DataFrame | None = None
) -> DataFrame:
    """Alerts for ``duplicate_pairs``.

    Given as a written table, the pairs have a known size: while they are small they
    are sent to the transactions, which then stay where they are.
    """
    pairs = duplicate_pairs(transactions, rule) if pairs is None else short(pairs)
    # One join for both sides of a pair: the pair is listed twice and folded again.
    sides = pairs.select(
        "*", F.posexplode(F.array("seq_1", "seq_2")).alias("side", "txn_seq"))
    details = (
        screened(transactions).filter(F.col("debit") >= F.lit(rule.min_amount).cast("decimal(18,2)"))
        .select("txn_seq", "txn_id", "bank", "operation_type", _pointer().alias("source"))
    )
    pair_columns = pairs.columns
    both = sides.join(details, "txn_seq").groupBy(*pair_columns).agg(
        *[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s + 1}")
          for s in (0, 1) for c in ("txn_id", "bank", "operation_type", "source")])
    ids = F.array("txn_id_1", "txn_id_2")
    return _draft(
        both, 1, "P1", "HIGH",
        k_vendor=F.col("vendor_key"), k_amount=F.col("debit_1"), k_day=F.col("date_1"), k_seq=F.col("seq_1"),
        vendor=F.col("vendor_key"), amount=F.col("debit_1"), amount_type="Transaction Amount",
        date_1=F.col("date_1"), date_2=F.col("date_2"),
        bank=F.col("bank_1"), operation_type=F.col("operation_type_1"),
        source_loc=F.concat_ws(" & ", "source_1", "source_2"),
        evidence=F.concat(
            F.lit("Same vendor, "), money_text(F.col("debit_1")), F.lit(" & "), money_text(F.col("debit_2")),
            F.lit(f" (within ±{_percent(rule.amount_tolerance)}% tolerance), "), F.col("days_apart").cast("string"), F.lit(" day(s) apart")),
        txn_ids=_id_text(ids), txns=_links(ids),
        next_step="Request invoices for both transactions, verify with AP",
        risk="Possible duplicate processing or vendor billing error",
        action="Verify both payments cleared, investigate with vendor",
    )


# --- new counterparties --------------------------------------------------------

def _large(rule: C.CounterpartyRule) -> Column:
    return F.col("debit") > F.lit(rule.min_amount).cast("decimal(18,2)")


def first_large_payments(
    transactions: DataFrame, rule: C.CounterpartyRule = C.DEFAULT.counterparty
) -> DataFrame:
    """``txn_seq`` of the first large payment on the first day a vendor is paid.

    Ids follow the date, so the smallest id among a vendor's large payments lies on
    the first day with one; a single aggregation finds it.
    """
    large = _large(rule)
    return (
        debits(transactions).groupBy("vendor_key")
        .agg(F.min("date").alias("first_date"),
             F.min(F.when(large, F.col("date"))).alias("large_date"),
             F.min(F.when(large, F.col("txn_seq"))).alias("txn_seq"))
        .filter(F.col("large_date") == F.col("first_date"))
        .filter(~contains_any(F.col("vendor_key"), rule.excluded_words))
        .select("txn_seq")
    )


def new_counterparties(
    transactions: DataFrame, rule: C.CounterpartyRule = C.DEFAULT.counterparty, firsts: DataFrame | None = None
) -> DataFrame:
    """Alerts for ``first_large_payments``, which may be given as a written table."""
    firsts = first_large_payments(transactions, rule) if firsts is None else short(firsts)
    ids = F.array("txn_id")
    return _draft(
        debits(transactions).filter(_large(rule)).join(firsts, "txn_seq", "left_semi"), 2, "P1", "HIGH",
        k_vendor=F.col("vendor_key"), k_seq=F.col("txn_seq"),
        vendor=F.col("vendor_key"), amount=F.col("debit"), amount_type="Transaction Amount",
        date_1=F.col("date"), bank=F.col("bank"), operation_type=F.col("operation_type"),
        source_loc=_pointer(),
        evidence=F.concat(F.lit("First transaction in dataset window: "), money_text(F.col("debit"))),
        txn_ids=_id_text(ids), txns=_links(ids),
        next_step="Request supplier onboarding docs: tax form (W-9/W-8 if US; VAT registration if EU/UK), "
                  "contract/PO, approval documentation",
        risk="No prior transaction history in dataset period",
        action="Verify vendor legitimacy and authorization",
    )


# --- round amounts ---------------------------------------------------------------

def round_payments(transactions: DataFrame, rule: C.RoundAmountRule = C.DEFAULT.round_amount) -> DataFrame:
    return debits(transactions).filter(
        (F.col("debit") >= rule.step) & (F.col("debit") % rule.step == 0)
        & ~contains_any(F.col("description_clean"), rule.fixed_cost_words))


def round_amounts(transactions: DataFrame, rule: C.RoundAmountRule = C.DEFAULT.round_amount) -> DataFrame:
    # Few payments are round: they are looked for once, written, and read four times.
    rows = settled(transactions.sparkSession, round_payments(transactions, rule).select(
        "debit", "date", "bank", "operation_type", "vendor_key", "txn_seq", "txn_id"), "round")
    overall = rows.agg(F.count(F.lit(1)).alias("n"))
    amounts = (
        rows.groupBy("debit").agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"),
            F.min("bank").alias("bank_low"), F.max("bank").alias("bank_high"),
            F.min("operation_type").alias("type_low"), F.max("operation_type").alias("type_high"))
        .filter(F.col("n") >= rule.min_rows_per_amount)
        .filter(overall.scalar() >= rule.min_rows_overall)
    )
    vendors = _first_rows(
        rows.groupBy("debit", "vendor_key").agg(F.min("txn_seq").alias("txn_seq")),
        ["debit"], ["txn_seq"], rule.listed_vendors)
    ids = _first_rows(rows.select("debit", "txn_seq", "txn_id"), ["debit"], ["txn_seq"], rule.listed_ids)
    joined = (
        amounts
        .join(_gathered(vendors, ["debit"], "vendor_key").withColumnRenamed("items", "vendors"), "debit")
        .join(_gathered(ids, ["debit"], "txn_id").withColumnRenamed("items", "ids"), "debit")
    )
    count, listed = F.col("n").cast("string"), _field(F.col("ids"), "txn_id")
    return _draft(
        joined, 3, "P2", "MEDIUM",
        k_amount=F.col("debit"),
        vendor=F.concat(count, F.lit(" transactions: "),
                        F.array_join(_field(F.col("vendors"), "vendor_key"), ", "), F.lit("...")),
        amount=F.col("debit"), amount_type="Transaction Amount",
        date_1=F.col("first"), date_2=F.col("last"),
        bank=_one_or_multiple("bank_low", "bank_high"),
        operation_type=_one_or_multiple("type_low", "type_high"),
        source_loc=F.concat(F.lit("Multiple ("), count, F.lit(" txns)")),
        evidence=F.concat(count, F.lit(" payments of exactly "), money_text(F.col("debit"))),
        txn_ids=_id_text(listed), txns=_links(listed),
        next_step="Request invoices, review for estimation or manual entry",
        risk="Unusual clustering of exact amounts (may indicate estimation)",
        action="Review for potential manipulation or estimation errors",
    )


# --- split payments ------------------------------------------------------------------

def split_days(transactions: DataFrame, rule: C.SplitRule = C.DEFAULT.split) -> DataFrame:
    """Vendor-days with several payments over the total, as ``(date, vendor_key)``."""
    return (
        debits(transactions).groupBy("date", "vendor_key").agg(F.count(F.lit(1)).alias("n"), F.sum("debit").alias("total"))
        .filter((F.col("n") >= rule.min_count) & (F.col("total") > F.lit(rule.min_total).cast("decimal(18,2)")))
        .select("date", "vendor_key")
    )


def split_payments(transactions: DataFrame, rule: C.SplitRule = C.DEFAULT.split) -> DataFrame:
    keys = ["date", "vendor_key"]
    days = settled(transactions.sparkSession, split_days(transactions, rule), "split-days")
    # Only payments of a qualifying vendor-day are summed up and listed.
    rows = debits(transactions).join(short(days), keys, "left_semi")
    listed = F.sort_array(F.collect_list(F.struct("txn_seq", "txn_id"))).alias("ids")
    figures = [
        F.count(F.lit(1)).alias("n"), F.sum("debit").alias("total"), F.max("debit").alias("largest"),
        F.min("bank").alias("bank_low"), F.max("bank").alias("bank_high"),
        F.min("operation_type").alias("type_low"), F.max("operation_type").alias("type_high")]
    if rule.listed_ids is None:
        groups = rows.groupBy(*keys).agg(*figures, listed)
    else:
        ids = _first_rows(rows.select(*keys, "txn_seq", "txn_id"), keys, ["txn_seq"], rule.listed_ids)
        groups = rows.groupBy(*keys).agg(*figures).join(ids.groupBy(*keys).agg(listed), keys)
    shown = rows.select(*keys, "txn_seq", "source_file", "source_sheet", "source_row")
    shown = _first_rows(shown, keys, ["txn_seq"], rule.listed_sources).withColumn("source", _pointer())
    gathered = groups.join(_gathered(shown, keys, "source").withColumnRenamed("items", "sources"), keys)
    count, ids = F.col("n").cast("string"), _field(F.col("ids"), "txn_id")
    sources = F.array_join(_field(F.col("sources"), "source"), "; ")
    more = lambda shown: F.concat(F.lit(" (+"), (F.col("n") - shown).cast("string"), F.lit(" more)"))
    over = lambda shown, text: F.when(F.col("n") > shown, F.concat(text, more(shown))).otherwise(text)
    return _draft(
        gathered, 4, "P2", "MEDIUM",
        k_date=F.col("date"), k_vendor=F.col("vendor_key"),
        vendor=F.col("vendor_key"), amount=F.col("total"), amount_type="Total Paid (Multiple Transactions)",
        date_1=F.col("date"),
        bank=_one_or_multiple("bank_low", "bank_high"),
        operation_type=_one_or_multiple("type_low", "type_high"),
        source_loc=over(rule.listed_sources, sources),
        evidence=F.concat(
            count, F.lit(" payments totaling "), money_text(F.col("total")), F.lit(" on same day"),
            F.when(F.col("largest") > F.lit(rule.large_payment).cast("decimal(18,2)"), F.lit(f" (at least one >${_thousands(rule.large_payment)})"))
            .otherwise(F.lit("")),
            F.lit(", may indicate approval limits")),
        txn_ids=_id_text(ids) if rule.listed_ids is None else over(rule.listed_ids, _id_text(ids)), txns=_links(ids),
        next_step="Verify business justification and approval chain",
        risk="Potential approval splitting pattern",
        action="Review reason for multiple payments to same vendor",
    )


# --- weekend activity -------------------------------------------------------------------

def run_statistics(transactions: DataFrame, rule: C.WeekendRule = C.DEFAULT.weekend) -> DataFrame:
    """One row: number of debits, their percentile (null for few rows), threshold and floor."""
    stats = exact_percentile(transactions.filter(F.col("debit") > 0), "debit", rule.percentile)
    floor = F.lit(rule.floor).cast("decimal(24,6)")
    p95 = F.when(F.col("n") > rule.percentile_above_rows, F.col("percentile"))
    return stats.select(
        F.col("n").alias("weekend_outflow_txn_count"), p95.alias("p95_debit"),
        F.greatest(floor, p95).alias("weekend_threshold"), floor.alias("weekend_threshold_floor"))


def _threshold(transactions: DataFrame, rule: C.WeekendRule, stats: DataFrame | None) -> Column:
    """The threshold as a scalar subquery; ``stats`` is a written ``run_statistics`` row."""
    row = run_statistics(transactions, rule) if stats is None else stats
    return row.select("weekend_threshold").scalar()


def weekend_hits(
    transactions: DataFrame, rule: C.WeekendRule = C.DEFAULT.weekend, stats: DataFrame | None = None
) -> DataFrame:
    threshold = _threshold(transactions, rule, stats)
    return (
        debits(transactions)
        .filter((F.weekday("date") >= 5) & (F.col("debit") > F.lit(rule.floor).cast("decimal(18,2)")))
        .filter((F.col("debit") > threshold) & ~contains_any(F.col("description_clean"), rule.excluded_words))
    )


def written_hits(
    transactions: DataFrame, rule: C.WeekendRule = C.DEFAULT.weekend, stats: DataFrame | None = None
) -> DataFrame:
    """:func:`weekend_hits`, written with what the alerts say of them: both forms read these several times."""
    return settled(transactions.sparkSession, weekend_hits(transactions, rule, stats).select(
        "txn_seq", "txn_id", "date", "debit", "bank", "operation_type", "vendor_key", "source_file", "source_sheet", "source_row"), "weekend")


def _day_name() -> Column:
    return F.when(F.weekday("date") == 5, F.lit("Sat")).otherwise(F.lit("Sun"))


def weekend_single(
    transactions: DataFrame, rule: C.WeekendRule = C.DEFAULT.weekend, stats: DataFrame | None = None, hits: DataFrame | None = None
) -> DataFrame:
    """One alert per hit, if there are only a few; ``hits`` are :func:`written_hits`."""
    hits = written_hits(transactions, rule, stats) if hits is None else hits
    few = hits.agg(F.count(F.lit(1)).alias("n")).scalar() <= rule.collapse_above
    ids = F.array("txn_id")
    return _draft(
        hits.filter(few), 5, "P3", "LOW",
        k_seq=F.col("txn_seq"),
        vendor=F.col("vendor_key"), amount=F.col("debit"), amount_type="Transaction Amount",
        date_1=F.col("date"), bank=F.col("bank"), operation_type=F.col("operation_type"),
        source_loc=_pointer(),
        evidence=F.concat(F.lit("Posted on "), _day_name(),
                          F.lit(" (posting date may differ from transaction date)")),
        txn_ids=_id_text(ids), txns=_links(ids),
        next_step="Verify business justification if material",
        risk="Weekend posting (review context)",
        action="Note: Posting date may differ from processing date",
    )


def weekend_collapsed(
    transactions: DataFrame, rule: C.WeekendRule = C.DEFAULT.weekend, stats: DataFrame | None = None, hits: DataFrame | None = None
) -> DataFrame:
    """One summary alert for more than a few hits; ``hits`` are :func:`written_hits`."""
    hits = written_hits(transactions, rule, stats) if hits is None else hits
    summary = hits.agg(
        F.count(F.lit(1)).alias("n"), F.sum("debit").alias("total"),
        F.min("date").alias("first"), F.max("date").alias("last"),
        F.min("bank").alias("bank_low"), F.max("bank").alias("bank_high"),
    ).filter(F.col("n") > rule.collapse_above)
    first_ids = (
        hits.select("txn_seq", "txn_id").orderBy("txn_seq").limit(rule.listed_ids)
        .agg(F.sort_array(F.collect_list(F.struct("txn_seq", "txn_id"))).alias("items")).scalar()
    )
    label = F.concat(
        F.substring("vendor_key", 1, rule.vendor_chars), F.lit(" ("), money_text(F.col("debit"), 0),
        F.lit(", "), _day_name(), F.lit(")"))
    top = (
        hits.select((-F.col("debit")).alias("minus"), "txn_seq", label.alias("label"))
        .orderBy("minus", "txn_seq").limit(rule.listed_top)
        .agg(F.sort_array(F.collect_list(F.struct("minus", "txn_seq", "label"))).alias("items")).scalar()
    )
    threshold = _threshold(transactions, rule, stats)
    full = summary.select("*", first_ids.alias("ids"), top.alias("top"), threshold.alias("threshold"))
    count, ids = F.col("n").cast("string"), _field(F.col("ids"), "txn_id")
    return _draft(
        full, 6, "P3", "LOW",
        vendor=F.concat(count, F.lit(" transactions; see details")),
        amount=F.col("total"), amount_type="Total Amount (Multiple Transactions)",
        date_1=F.col("first"), date_2=F.col("last"),
        bank=_one_or_multiple("bank_low", "bank_high"), operation_type="Multiple",
        source_loc=F.concat(F.lit("Multiple ("), count, F.lit(" txns)")),
        evidence=F.concat(
            count, F.lit(" weekend postings >"), money_text(F.col("threshold"), 0),
            F.lit(", totaling "), money_text(F.col("total")), F.lit(". Top 3: "),
            F.array_join(_field(F.col("top"), "label"), "; ")),
        txn_ids=F.concat(_id_text(ids), F.when(F.col("n") > rule.listed_ids, F.lit("...")).otherwise(F.lit(""))),
        txns=_links(ids),
        next_step="Review for business context; posting dates may differ from processing dates",
        risk="Weekend posting pattern (review context)",
        action="Note: Weekend postings common for automated systems and deadline-driven payments",
    )


# --- high-velocity days --------------------------------------------------------------------

def large_payments(transactions: DataFrame, rule: C.VelocityRule = C.DEFAULT.velocity) -> DataFrame:
    return debits(transactions).filter(F.col("debit") > F.lit(rule.min_amount).cast("decimal(18,2)"))


def high_velocity(transactions: DataFrame, rule: C.VelocityRule = C.DEFAULT.velocity) -> DataFrame:
    rows = large_payments(transactions, rule)
    days = rows.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("debit").alias("total")).filter(
        F.col("n") >= rule.min_count)
    listed = _first_rows(rows.select("date", "txn_seq", "txn_id"), ["date"], ["txn_seq"], rule.listed_ids)
    joined = days.join(_gathered(listed, ["date"], "txn_id"), "date")
    count, ids = F.col("n").cast("string"), _field(F.col("items"), "txn_id")
    return _draft(
        joined, 7, "P3", "LOW",
        k_date=F.col("date"),
        vendor=F.concat(count, F.lit(" vendors")),
        amount=F.col("total"), amount_type="Total Amount (Single Day)",
        date_1=F.col("date"), bank="Multiple", operation_type="Multiple", source_loc="See Txn_IDs",
        evidence=F.concat(
            count, F.lit(" large payments (>"), money_text(F.lit(rule.min_amount).cast("decimal(18,2)"), 0),
            F.lit(") on single day")),
        txn_ids=_id_text(ids), txns=_links(ids),
        next_step="Review for business context (e.g., month-end, quarter-end)",
        risk="Unusual concentration of payments",
        action="Review for business justification (e.g., period-end processing)",
    )


# --- vendor growth -----------------------------------------------------------------------------

def growth_payments(transactions: DataFrame, rule: C.GrowthRule = C.DEFAULT.growth) -> DataFrame:
    """Payments the growth rule looks at, with their ``month``."""
    rows = debits(transactions)
    if "operation_type" in rows.columns:
        rows = rows.filter(~F.col("operation_type").isin(*rule.excluded_categories))
    return rows.withColumn("month", F.trunc("date", "MM"))


def vendor_growth(transactions: DataFrame, rule: C.GrowthRule = C.DEFAULT.growth) -> DataFrame:
    """Vendors whose spend in the last month is a multiple of their first active month."""
    dates = transactions.agg(F.countDistinct("date").alias("n")).scalar()
    rows, spark = growth_payments(transactions, rule), transactions.sparkSession
    # Written once: the months and the growing vendors follow from a row per vendor and month.
    monthly = settled(spark, rows.groupBy("vendor_key", "month").agg(
        F.sum("debit").alias("spend"), F.count(F.lit(1)).alias("n"), F.max("date").alias("last_day")), "growth-months")
    latest = monthly.agg(F.max("month").alias("m")).scalar()
    months = monthly.agg(F.countDistinct("month").alias("n")).scalar()
    in_latest = lambda c: F.max(F.when(F.col("month") == latest, F.col(c)))
    growing = settled(spark, (
        monthly.groupBy("vendor_key").agg(
            F.min("month").alias("base_month"), F.min_by("spend", "month").alias("base_spend"),
            F.min_by("n", "month").alias("base_n"),
            in_latest("month").alias("late_month"), in_latest("spend").alias("late_spend"),
            in_latest("n").alias("late_n"), in_latest("last_day").alias("anchor"))
        .filter((F.col("base_spend") > F.lit(rule.baseline_min).cast("decimal(18,2)"))
                & (F.col("late_spend") > F.col("base_spend") * F.lit(rule.growth_factor).cast("decimal(6,2)")))
        .filter((dates > rule.min_dates) & (months >= rule.min_months))
    ), "growing")
    # Only payments of a growing vendor's two months are ranked.
    wanted = short(growing).select(
        "vendor_key", F.explode(F.array("base_month", "late_month")).alias("month"))
    top = _first_rows(
        rows.select("vendor_key", "month", "debit", "txn_seq", "txn_id").join(wanted, ["vendor_key", "month"], "left_semi"),
        ["vendor_key", "month"], [F.desc("debit"), "txn_seq"], rule.listed_ids)
    listed = _gathered(top, ["vendor_key", "month"], "txn_id")
    named = lambda month, items: listed.select(
        "vendor_key", F.col("month").alias(month), F.col("items").alias(items))
    full = (
        growing.join(named("base_month", "base_items"), ["vendor_key", "base_month"])
        .join(named("late_month", "late_items"), ["vendor_key", "late_month"])
    )
    base, late = month_text(F.col("base_month")), month_text(F.col("late_month"))

    def compact(items: str, n: str) -> Column:
        text = _id_text(_field(F.col(items), "txn_id"))
        rest = F.concat(F.lit(" (+"), (F.col(n) - rule.listed_ids).cast("string"), F.lit(" more)"))
        return F.when(F.col(n) > rule.listed_ids, F.concat(text, rest)).otherwise(text)

    return _draft(
        full, 8, "P3", "LOW",
        k_vendor=F.col("vendor_key"),
        vendor=F.col("vendor_key"), amount=F.col("late_spend") - F.col("base_spend"),
        amount_type="Baseline-to-Latest Growth (Delta)",
        date_1=F.col("base_month"), date_2=F.col("late_month"), anchor_date=F.col("anchor"),
        bank="Multiple", operation_type="Multiple (Aggregate)",
        source_loc=F.concat(F.lit("Monthly vendor totals: "), base, F.lit("→"), late),
        evidence=F.concat(
            base, F.lit(": "), money_text(F.col("base_spend")), F.lit(" → "), late, F.lit(": "),
            money_text(F.col("late_spend")), F.lit(" (baseline = first active month in period)")),
        txn_ids=F.concat(
            F.lit("Baseline "), base, F.lit(": "), compact("base_items", "base_n"), F.lit(" | Latest "),
            late, F.lit(": "), compact("late_items", "late_n")),
        txns=F.concat(
            _links(_field(F.col("base_items"), "txn_id"), "Baseline"),
            _links(_field(F.col("late_items"), "txn_id"), "Latest")),
        next_step="Review contract terms, pricing changes, volume justification",
        risk="Dependency increasing over time",
        action="Review contract terms and pricing changes",
    )


# --- all rules -------------------------------------------------------------------------------------

def number_alerts(drafts: DataFrame) -> DataFrame:
    """Number draft alerts by rule, then by the natural order of each rule."""
    numbered = ranged_sequence(drafts, list(SORT_KEYS), "alert_seq", "alerts")
    return numbered.withColumn("alert_id", F.format_string("A%04d", "alert_seq")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FINDINGS])


@dataclass(frozen=True)
class Prepared:
    """Small results the rules build on; written tables, so that their size is known."""

    stats: DataFrame
    pairs: DataFrame
    firsts: DataFrame


def draft_alerts(
    transactions: DataFrame, config: C.ScreeningConfig = C.DEFAULT, prepared: Prepared | None = None
) -> DataFrame:
    """All rules; what ``prepared`` holds is computed inside the query if it is absent."""
    stats, pairs, firsts = (prepared.stats, prepared.pairs, prepared.firsts) if prepared else (None, None, None)
    hits = written_hits(transactions, config.weekend, stats)
    drafts = [
        duplicate_payments(transactions, config.duplicate, pairs),
        new_counterparties(transactions, config.counterparty, firsts),
        round_amounts(transactions, config.round_amount),
        split_payments(transactions, config.split),
        weekend_single(transactions, config.weekend, stats, hits),
        weekend_collapsed(transactions, config.weekend, stats, hits),
        high_velocity(transactions, config.velocity),
        vendor_growth(transactions, config.growth),
    ]
    return reduce(DataFrame.unionByName, drafts)


def screen(transactions: DataFrame, config: C.ScreeningConfig = C.DEFAULT) -> DataFrame:
    """All rules over a transactions table, as numbered findings.

    Numbering reads the drafts more than once; a caller with large data writes
    ``draft_alerts`` first and numbers the written table (see ``plans``).
    """
    return number_alerts(draft_alerts(transactions, config))
