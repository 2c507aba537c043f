import random
import re

from pyspark.sql import functions as F

from helpers import row, transactions
from ledgersieve import config as C
from ledgersieve.functions.classify import keyword_category

ONE_EACH = {
    "June payroll run": "Payroll & Benefits", "IRS USATAXPYMT": "Taxes & Government",
    "monthly service charge": "Bank Fees", "Slack sub": "Software & IT", "Stripe transfer": "Card Processing",
    "office rent": "Rent & Facilities", "City Utilities": "Utilities & Services", "Staples 12": "Office & Supplies",
    "Annual audit": "Professional Services", "FedEx 99": "Shipping & Logistics", "UPS": "Shipping & Logistics",
    "insurance premium": "Insurance & Security", "raw material": "Inventory & Suppliers",
    "lockbox 7": "Customer Payments", "Field service visit": "Contractor & Staffing",
    "petty cash": "Cash Management", "travel expense": "Employee Reimbursements",
    "Outward Payments Bob": "Vendor Payments", "term loan": "Loans & Financing",
    "Google ads": "Marketing & Advertising", "diesel": "Fuel & Fleet", "owner draw": "Owner Transactions",
    "rubio": "Owner Transactions", "interest earned": "Financial Income", "transfer to savings": "Internal Transfers",
    "something else": "Other", "banking link": "Office & Supplies", "pay  roll": "Other",
    "check 1001": "Vendor Payments", "federal\ttax": "Taxes & Government",
}


def categories(spark, texts, kind=None):
    frame = spark.createDataFrame([(i, t, kind) for i, t in enumerate(texts)], "i int, t string, k string")
    column = keyword_category(F.col("t"), F.col("k") if kind else None)
    return [r.c for r in frame.select("i", column.alias("c")).orderBy("i").collect()]


def test_one_description_per_category(spark):
    assert categories(spark, list(ONE_EACH)) == list(ONE_EACH.values())
    assert categories(spark, [None, ""]) == ["Other", "Other"]


def test_type_is_appended(spark):
    assert categories(spark, ["plain text"], "PAYROLL") == ["Payroll & Benefits"]


def test_grouped_patterns_match_the_same_texts(spark):
    rng = random.Random(3)
    words = [p.strip(" ^$").replace(r"\d+", "12").replace(".*", " x ") for _, ps in C.CATEGORY_PHRASES for p in ps]
    texts = []
    for w in words:
        texts += [w, f"pre {w} post", w[:-1], f"x{w}"]
    texts += [" ".join(rng.choice(words)[:rng.randint(2, 9)] for _ in range(3)) for _ in range(300)]

    def expected(t):
        for name, phrases in C.CATEGORY_PHRASES:
            if any(re.search(p.replace(" ", r"\s+"), t.lower()) for p in phrases):
                return name
        return "Other"

    assert categories(spark, texts) == [expected(t) for t in texts]


def test_corrections_and_direction(spark):
    rows = [
        row("2024-01-01", "customer payment irs refund", credit=1),
        row("2024-01-01", "lockbox outward", credit=1),
        row("2024-01-01", "Northbridge Retail store", debit=1),
        row("2024-01-01", "Northbridge Retail store", credit=1),
        row("2024-01-01", "hardware of Harbor Wholesale", credit=1),
        row("2024-01-01", "hardware wholesale", debit=1),
        row("2024-01-01", "stripe payout 7", credit=1),
        row("2024-01-01", "stripe processing", debit=1),
        row("2024-01-01", "stripe processing", credit=1),
        row("2024-01-01", "neither"),
        row("2024-01-01", "both", debit=1, credit=1),
    ]
    got = [(r.operation_type, r.direction) for r in transactions(spark, rows).orderBy("txn_seq").collect()]
    assert got == [
        ("Taxes & Government", "Inflow"), ("Vendor Payments", "Inflow"), ("Vendor Payments", "Outflow"),
        ("Customer Payments", "Inflow"), ("Customer Payments", "Inflow"), ("Inventory & Suppliers", "Outflow"),
        ("Card Settlement (Income)", "Inflow"), ("Card Fees", "Outflow"), ("Card Processing", "Inflow"),
        ("Other", "Unknown"), ("Other", "Inflow"),
    ]
