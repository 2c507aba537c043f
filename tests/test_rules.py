import dataclasses
import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import brute
from helpers import findings, frame, row, transactions
from ledgersieve import config as C
from ledgersieve.operators import screening as S
from ledgersieve.schema import FINDINGS


def ordered(drafts):
    return drafts.orderBy(*[F.asc_nulls_first(k) for k in S.SORT_KEYS]).collect()


def ids(drafts):
    return [r.txn_ids for r in ordered(drafts)]


# --- random tables, one vendor, day and amount holding a third of the rows ---------------

VENDORS = ("Alpha Works", "Beta Consulting", "Gamma Freight", "Delta Hosting", "Epsilon insurance", "Zeta")


def skewed(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        vendor = "Hot Trading" if rng.random() < 0.34 else rng.choice(VENDORS)
        amount = rng.choice([
            1000 * rng.randint(1, 3), 199, round(rng.uniform(50, 400), 2), round(rng.uniform(20000, 90000), 2),
            100 + rng.randint(0, 3)])
        when = dt.date(2024, 1, 5) if rng.random() < 0.34 else dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 90))
        extra = rng.choice(["", " service fee", " lease", " INV 77"])
        debit, credit = (amount, None) if rng.random() < 0.85 else (None, amount)
        rows.append(row(when, vendor + extra, debit, credit, bank=rng.choice("ABC")))
    return rows


@pytest.mark.parametrize("seed,n", [(1, 60), (2, 700), (3, 700)])
def test_rules_equal_brute_force(spark, seed, n):
    rows = skewed(seed, n)
    table = transactions(spark, rows, partitions=3)
    plain = frame(table)
    assert ids(S.duplicate_payments(table)) == brute.duplicates(plain)
    assert ids(S.new_counterparties(table)) == brute.counterparties(plain)
    assert [(r.vendor, r.txn_ids) for r in ordered(S.round_amounts(table))] == brute.rounds(plain)
    assert [((r.date_1, r.vendor), r.amount, r.txn_ids) for r in ordered(S.split_payments(table))] \
        == brute.splits(plain)
    assert [(r.date_1, int(r.vendor.split()[0]), r.txn_ids) for r in ordered(S.high_velocity(table))] \
        == brute.velocity(plain)
    assert [(r.vendor, r.amount, r.txn_ids) for r in ordered(S.vendor_growth(table))] == brute.growth(plain)


# --- duplicates --------------------------------------------------------------------------

def dup(spark, *rows):
    return ids(S.duplicate_payments(transactions(spark, list(rows))))


@pytest.mark.parametrize("second,days,hit", [
    ("10099.99", 1, True), ("10100.00", 1, False), ("10000.00", 3, True), ("10000.00", 4, False),
    ("10000.00", 0, False)])
def test_duplicate_boundaries(spark, second, days, hit):
    start = dt.date(2024, 3, 4)
    got = dup(spark, row(start, "Zeta", 10000), row(start + dt.timedelta(days), "Zeta", second))
    assert bool(got) is hit


def test_duplicate_minimum_fees_and_categories(spark):
    pair = lambda text, amount: [row("2024-03-04", text, amount), row("2024-03-05", text, amount)]
    assert not dup(spark, *pair("Zeta", "99.99")) and dup(spark, *pair("Zeta", "100.00"))
    fee = dict(operation_type="Other")
    # the phrase counts on the first row of a pair only
    assert not dup(spark, row("2024-03-04", "Zeta account fee", 500, **fee),
                   row("2024-03-05", "Zeta account fee", 500, **fee))
    vendor = "Zeta"
    first_plain = [row("2024-03-04", vendor, 500, **fee), row("2024-03-05", vendor + " INC account fee", 501, **fee)]
    assert not dup(spark, *first_plain)  # another vendor key
    assert not dup(spark, *pair("Zeta payroll", 500))


def test_duplicate_only_adjacent_amounts(spark):
    # 1000.00 and 1002.00 are not neighbours: 1001.00 of another month lies between them
    assert dup(spark, row("2024-03-04", "Zeta", "1000.00"), row("2024-05-01", "Zeta", "1001.00"),
               row("2024-03-05", "Zeta", "1002.00")) == []


def test_duplicate_across_amount_buckets(spark):
    """A pair is found wherever its amounts lie, also at the border of two buckets."""
    rng, rows, amount = random.Random(5), [], Decimal("100.00")
    while amount < 2_000_000:
        start = dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 300))
        rows += [row(start, "Zeta", amount), row(start + dt.timedelta(1), "Zeta", (amount * Decimal("1.009")).quantize(Decimal("0.01")))]
        amount = (amount * Decimal("1.013")).quantize(Decimal("0.01"))
    table = transactions(spark, rows)
    got = ids(S.duplicate_payments(table))
    assert got == brute.duplicates(frame(table)) and len(got) > 300


# --- other boundaries ------------------------------------------------------------------------

def test_counterparty_boundaries(spark):
    def hit(*rows):
        return ids(S.new_counterparties(transactions(spark, list(rows))))
    assert not hit(row("2024-01-02", "Zeta", "50000.00"))
    assert hit(row("2024-01-02", "Zeta", "50000.01")) == ["TXN_00001"]
    assert not hit(row("2024-01-02", "Zeta", 10), row("2024-01-03", "Zeta", 60000))
    assert hit(row("2024-01-02", "Zeta", 60000), row("2024-01-02", "Zeta", 70000)) == ["TXN_00001"]
    assert hit(row("2024-01-02", "Zeta", 10), row("2024-01-02", "Zeta", 70000)) == ["TXN_00002"]
    assert not hit(row("2024-01-02", "Zeta utility", 60000))
    # an earlier receipt does not make the vendor known
    assert hit(row("2024-01-01", "Zeta", credit=5), row("2024-01-02", "Zeta", 60000)) == ["TXN_00002"]


def test_round_amount_boundaries(spark):
    def hit(*rows):
        return [(r.vendor, r.txn_ids, r.bank) for r in ordered(S.round_amounts(transactions(spark, list(rows))))]
    two = [row("2024-01-02", "Zeta", 2000), row("2024-01-03", "Zeta", 2000, bank="B")]
    assert hit(*two) == []
    assert hit(*two, row("2024-01-04", "Yota", 3000)) == \
        [("2 transactions: ZETA...", "TXN_00001, TXN_00002", "Multiple")]
    assert hit(*two, row("2024-01-04", "Zeta lease", 2000), row("2024-01-04", "Zeta", 500)) == []
    many = [row("2024-01-02", f"Vendor {c}", 4000) for c in "CABDEF"]
    assert hit(*many) == [("6 transactions: VENDOR C, VENDOR A...",
                           "TXN_00001, TXN_00002, TXN_00003, TXN_00004, TXN_00005", "A")]


def test_split_boundaries(spark):
    def hit(*amounts):
        return ordered(S.split_payments(transactions(spark, [row("2024-01-02", "Zeta", a) for a in amounts])))
    assert not hit(5000, 5000) and not hit(20000)
    (one,) = hit(5000, "5000.01")
    assert "at least one >$5k" in one.evidence and one.amount == Decimal("10000.01")
    (one,) = hit(4000, 3000, 3000, 2000)
    assert one.evidence == "4 payments totaling $12,000.00 on same day, may indicate approval limits"
    assert one.source_loc.endswith("R4 (+1 more)") and one.source_loc.count(" | ") == 6


def test_split_listing_limit_keeps_counts(spark):
    table = transactions(spark, [row("2024-01-02", "Zeta", 4000) for _ in range(7)])
    rule = dataclasses.replace(C.DEFAULT.split, listed_ids=3)
    (one,) = ordered(S.split_payments(table, rule))
    assert one.txn_ids == "TXN_00001, TXN_00002, TXN_00003 (+4 more)" and one.amount == 28000
    assert len(one.txns) == 3


def weekend(n_weekday, weekend_amounts, text="Zeta"):
    rows = [row("2024-01-03", "Other", 100 + i) for i in range(n_weekday)]
    return rows + [row("2024-01-06" if i % 2 == 0 else "2024-01-07", text, a) for i, a in enumerate(weekend_amounts)]


@pytest.mark.parametrize("hits,single,many", [(0, 0, 0), (1, 1, 0), (3, 3, 0), (4, 0, 1), (16, 0, 1)])
def test_weekend_counts(spark, hits, single, many):
    table = transactions(spark, weekend(400, [30000 + i for i in range(hits)]))
    assert len(ordered(S.weekend_single(table))) == single
    collapsed = ordered(S.weekend_collapsed(table))
    assert len(collapsed) == many
    if hits == 16:
        (one,) = collapsed
        assert one.txn_ids.count("TXN_") == 15 and one.txn_ids.endswith("...") and len(one.txns) == 15
        assert one.evidence.endswith("Top 3: ZETA ($30,015, Sun); ZETA ($30,014, Sat); ZETA ($30,013, Sun)")
    if hits == 1:
        assert ordered(S.weekend_single(table))[0].evidence.startswith("Posted on Sat ")


def test_weekend_threshold(spark):
    stats = S.run_statistics(transactions(spark, weekend(19, [90000]))).first()
    assert stats.p95_debit is None and stats.weekend_threshold == 25000
    stats = S.run_statistics(transactions(spark, weekend(20, [90000]))).first()
    assert stats.p95_debit is not None and stats.weekend_threshold == 25000
    stats = S.run_statistics(transactions(spark, weekend(2, [90000 + i for i in range(30)]))).first()
    assert stats.weekend_threshold == stats.p95_debit > 25000


def test_weekend_words_match_inside_words(spark):
    assert not ordered(S.weekend_single(transactions(spark, weekend(5, [40000], "Coach hire"))))
    assert ordered(S.weekend_single(transactions(spark, weekend(5, [40000], "Bus hire"))))
    assert not ordered(S.weekend_single(transactions(spark, weekend(5, [25000]))))


def test_velocity_boundaries(spark):
    def hit(*amounts):
        return ordered(S.high_velocity(transactions(spark, [row("2024-01-02", "Zeta", a) for a in amounts])))
    assert not hit(*[20001] * 4) and not hit(*[20001] * 4, 20000)
    (one,) = hit(*[20001] * 5)
    assert (one.vendor, one.evidence) == ("5 vendors", "5 large payments (>$20,000) on single day")
    (one,) = hit(*[20001] * 12)
    assert one.txn_ids.count("TXN_") == 10


def growth_rows(base, late, dates=31, text="Zeta", last=True):
    start = dt.date(2024, 1, 1)
    rows = [row(start + dt.timedelta(i), "filler", 1) for i in range(dates - 1)]
    rows += [row(start, text, base)]
    if last:
        rows += [row("2024-02-20", text, late)]
    return rows


@pytest.mark.parametrize("rows,hit", [
    (growth_rows("1000.01", "2000.03"), True),
    (growth_rows("1000.00", "9000.00"), False),
    (growth_rows("2000.00", "4000.00"), False),
    (growth_rows("2000.00", "4000.01"), True),
    (growth_rows("2000.00", "4000.01", dates=30), False),
    (growth_rows("2000.00", "0", last=False) + [row("2024-03-20", "filler", 1)], False),
    (growth_rows("2000.00", "5000.00", text="Zeta freight"), False),
    (growth_rows("2000.00", "5000.00") + [row("2024-03-05", "filler", 1)], False),
])
def test_growth_boundaries(spark, rows, hit):
    got = [r.vendor for r in ordered(S.vendor_growth(transactions(spark, rows)))]
    assert got == (["ZETA"] if hit else [])


def test_growth_lists_top_two(spark):
    rows = growth_rows("2000.00", "1.00") + [row("2024-02-21", "Zeta", a) for a in (3000, 3000, 4000)]
    (one,) = ordered(S.vendor_growth(transactions(spark, rows)))
    assert one.txn_ids == "Baseline 2024-01: TXN_00002 | Latest 2024-02: TXN_00035, TXN_00033 (+2 more)"
    assert (one.anchor_date, one.date_1, one.date_2) == (dt.date(2024, 2, 21), dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert [tuple(t) for t in one.txns] == [
        ("Baseline", "TXN_00002"), ("Latest", "TXN_00035"), ("Latest", "TXN_00033")]


# --- numbering and invariance ---------------------------------------------------------------------

def test_nothing_found_is_a_typed_empty_table(spark):
    found = findings(spark, transactions(spark, [row("2024-01-02", "Zeta", 1)]))
    assert found.count() == 0
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in FINDINGS]


def test_alert_numbers_and_input_order(spark):
    rows = skewed(7, 250)
    table = transactions(spark, rows)
    first = findings(spark, table).drop("txns").orderBy("alert_seq").collect()
    assert [r.alert_seq for r in first] == list(range(1, len(first) + 1))
    assert first[0].alert_id == "A0001"
    order = [C.RULE_NAMES.index(r.category) for r in first]
    assert order == sorted(order) and len(set(order)) >= 5
    mixed = table.orderBy(F.desc("txn_seq")).repartition(7)
    again = findings(spark, mixed).drop("txns").orderBy("alert_seq").collect()
    assert again == first


def test_texts_follow_the_settings(spark):
    config = dataclasses.replace(
        C.DEFAULT, duplicate=dataclasses.replace(C.DEFAULT.duplicate, amount_tolerance="0.025"),
        split=dataclasses.replace(C.DEFAULT.split, large_payment="7500.00"))
    table = transactions(spark, [row("2024-01-02", "Zeta", 1000), row("2024-01-03", "Zeta", 1020), row("2024-01-05", "Eta", 9000), row("2024-01-05", "Eta", 8000)])
    texts = [r.evidence for r in S.draft_alerts(table, config).where("category in ('Duplicate Payment', 'Split Payments')").collect()]
    assert any("(within ±2.5% tolerance)" in t for t in texts) and any("(at least one >$7,500)" in t for t in texts)
