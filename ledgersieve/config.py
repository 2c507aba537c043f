"""Thresholds, word lists and keyword rules.  Data only.

Phrases are written as plain text.  ``phrase_pattern`` turns a list of them
into one regular expression: a space stands for one or more white-space
characters, everything else is taken as written.
"""

from __future__ import annotations

import re

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Intake keywords
# ---------------------------------------------------------------------------

HEADER_SCAN_ROWS = 50
OPENING_SCAN_ROWS = 25
CLOSING_SCAN_ROWS = 200

DATE_WORDS = ("date", "posting date", "trans date", "value date")
DESCRIPTION_WORDS = ("description", "transaction", "details", "particulars", "narrative")
BALANCE_WORDS = ("balance", "running balance")
DEBIT_MARKERS = ("debit", "money out", "withdrawals", "paid out")
CREDIT_MARKERS = ("credit", "money in", "deposits", "additions", "paid in")
AMOUNT_MARKERS = ("amount",)
DEBIT_WORDS = ("debit", "money out", "withdrawal", "payments out", "paid out")
CREDIT_WORDS = ("credit", "money in", "deposit", "addition", "payments in", "paid in")
AMOUNT_WORDS = ("amount", "value")
TYPE_WORDS = ("type", "category", "transaction type")

OPENING_WORDS = (
    "beginning balance", "opening balance", "starting balance",
    "balance forward", "balance brought forward", "previous balance", "present balance",
    "account balance",
)
OPENING_ROW_WORDS = (
    "beginning balance", "opening balance", "starting balance",
    "balance forward", "balance brought forward",
)
CLOSING_WORDS = (
    "ending balance", "closing balance", "new balance",
    "balance carried forward", "balance carried fwd", "balance carry forward",
)
CLOSING_ROW_WORDS = (
    "ending balance", "closing balance", "new balance",
    "balance carried forward", "balance carried fwd",
)

# (shape of the text, Spark format); tried in order, month before day.  A time of
# day at the end of the text is cut off first.
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "M.d.yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"),
    (r"^\d{4}\d{2}\d{2}$", "yyyyMMdd"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
)
# Dates with a month name: the shape, and which groups are day, month and year.
_MONTH = (
    r"((?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?))\.?"
)
MONTH_NAME_DATES = (
    (rf"^(\d{{1,2}})(?:st|nd|rd|th)?[ \-/]+{_MONTH}[ ,\-/]+(\d{{4}}|\d{{2}})$", (1, 2, 3)),
    (rf"^{_MONTH}[ \-]+(\d{{1,2}})(?:st|nd|rd|th)?[ ,\-]+(\d{{4}}|\d{{2}})$", (2, 1, 3)),
)
# A day of the week in front, and a time of day behind a date.
DAY_OF_WEEK = r"^(?i:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?i:day)?\.?,? +"
TIME_OF_DAY = r"(T\d{4}(\d{2})?Z?| \d{1,2} ?[AaPp]\.?[Mm]\.?)$|[ T]\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)? ?([AaPp]\.?[Mm]\.?)? ?(Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"

# ---------------------------------------------------------------------------
# Payment-rail prefixes and trailing references
# ---------------------------------------------------------------------------

DESCRIPTION_PREFIXES = (
    r"^ACH\s+(CREDIT|DEBIT|PAYMENT)\s+-\s+",
    r"^WIRE\s+(TRANSFER|OUT|IN)\s+-\s+",
    r"^CHECK\s+PAID\s+#\d+\s+-\s+",
    r"^REMOTE\s+DEPOSIT\s+-\s+",
    r"^BILL\s+PAYMENT\s+-\s+",
    r"^SERVICE\s+FEE\s+-\s+",
    r"^MISC\.\s+CREDIT\s+-\s+",
    r"^Card\s+Purchase\s+\d+/\d+\s+\d+:\d+\s+",
    r"^Inward\s+Payments\s+",
    r"^Outward\s+Fast\s+Payments\s+",
    r"^Outward\s+Payments\s+",
    r"^CARD\s+PURCHASE\s+-\s+",
    r"^DEBIT\s+CARD\s+-\s+",
    r"^ONLINE\s+PAYMENT\s+-\s+",
)
DESCRIPTION_REFERENCE = r"\s+(INV|PO|CP|FP)\s*\d+$"

VENDOR_PREFIXES = (
    r"^ACH\s+(CREDIT|DEBIT|PAYMENT)\s*-\s*",
    r"^WIRE\s+(TRANSFER|OUT|IN)\s*-\s*",
    r"^CHECK\s+PAID\s+#\d+\s*-\s*",
    r"^REMOTE\s+DEPOSIT\s*-\s*",
    r"^BILL\s+PAYMENT\s*-\s*",
    r"^SERVICE\s+FEE\s*-\s*",
    r"^MISC\.?\s+CREDIT\s*-\s*",
    r"^CARD\s+PURCHASE\s*-\s*",
    r"^CARD\s+PURCHASE\s+\d{1,2}/\d{1,2}\s+\d{1,2}:\d{2}\s+",
    r"^DEBIT\s+CARD\s*-\s*",
    r"^CREDIT\s+CARD\s*-\s*",
    r"^ONLINE\s+PAYMENT\s*-\s*",
    r"^INWARD\s+PAYMENTS\s+",
    r"^OUTWARD\s+FAST\s+PAYMENTS\s+",
    r"^OUTWARD\s+PAYMENTS\s+",
    r"^FASTER\s+PAYMENTS\s*-\s*(OUT|IN)\s+",
    r"^FASTER\s+PAYMENTS\s+(OUT|IN)\s+",
)
VENDOR_REFERENCE = r"\s+(INV|PO|CP|FP|REF)\s*\d+$"
VENDOR_COMPANY_WORDS = r"\s+(LLC|INC|CORP|LTD|CO|COMPANY|CORPORATION|LIMITED)\b"
VENDOR_PUNCTUATION = ".,;:-"

# ---------------------------------------------------------------------------
# Category keywords, first hit wins.  A phrase that can only
# match where an earlier one already matched is left out.
# ---------------------------------------------------------------------------

OTHER_CATEGORY = "Other"

CATEGORY_PHRASES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Payroll & Benefits", (
        "payroll", "salary", "wages", "employee payment", "direct deposit.*employee",
        "gusto", "paychex", "health insurance", "dental insurance", "vision insurance",
        "401k", "retirement plan",
    )),
    ("Taxes & Government", (
        "irs ", "federal tax", "state tax", "sales tax", "income tax", "tax payment",
        "department of revenue", "franchise tax", "property tax", "employment tax", "eftps",
    )),
    ("Bank Fees", (
        "service fee", "monthly fee", "wire fee", "transaction fee", "overdraft", "nsf fee",
        "maintenance fee", "account fee", "service charge", "check printing fee",
        "ach fee", "ach origination fee", "wire transfer fee",
    )),
    ("Software & IT", (
        "software", "saas ", "cloud ", "hosting", "google workspace", "microsoft 365",
        "office 365", "adobe", "slack", "zoom", "dropbox", "amazon web services", "aws ",
        "azure", "salesforce", "hubspot", "quickbooks", "intuit", "tech subscription",
        "digital subscription", "ringcentral", "voip", "broadband", "bt business",
        "internet service",
    )),
    ("Card Processing", (
        "card purchase", "debit card", "credit card", "square", "stripe", "paypal",
        "merchant services", "pos ", "point of sale",
    )),
    ("Rent & Facilities", (
        "rent ", "lease payment", "office rent", "warehouse rent", "warehouse lease",
        "jul rent", "commercial lease", "facilities", "riverside properties",
        "property management", "property ltd", "direct debit.*property", "example property",
    )),
    ("Utilities & Services", (
        "electric", "gas bill", "water bill", "utilities", "phone bill", "telecom",
        "metro water", "vodafone", "waste management", "trash", "disposal", "recycling",
        "sanitation", "comcast", "at&t", "verizon", "internet & phone", "cleaning",
        "janitorial",
    )),
    ("Office & Supplies", (
        "office supplies", "staples", "office depot", "amazon.*office", "amazon business",
        "paper", "printer", "ink", "maintenance & repair", r"supplies \d+",
        "global industrial", "industrial supply", "safety equipment", "quality maintenance",
        "home depot", "screwfix", "nursery supply", "commercial nursery", "hardware store",
    )),
    ("Professional Services", (
        "legal fees", "attorney", "law firm", "accounting services", "cpa ", "audit",
        "consulting", "contracting", "securenet", "it services", "tech support",
    )),
    ("Shipping & Logistics", (
        "fedex", "ups ", "ups$", "usps", "dhl", "shipping", "freight", "logistics",
        "delivery service", "courier", "express delivery",
    )),
    ("Insurance & Security", (
        "insurance", "workers comp", "security alarm", "security monitoring", "alarm co",
        "security inc", "ironclad security", "security service",
    )),
    ("Inventory & Suppliers", (
        "supplier", "vendor payment", "inventory", "wholesale", "purchase order", r" po \d+",
        "material", "stock purchase", "packaging", "electronic parts", "parts ltd",
        "hardware", "furniture", "ikea", "midwest industrial parts",
    )),
    ("Customer Payments", (
        "customer payment", "invoice payment", r"inv \d+", "payment received", "lockbox",
        "remote deposit", "sales receipt", "revenue", "inward payments",
        "inward fast payments", "faster payments - in", "faster payments in",
        "brightline stores", "eastcoast imports", "riverstone retail", "riverbend markets",
        "northbridge retail", "retail llc", "wire incoming", "ach credit.*customer",
        "nova electronics", "cedarstone foods", "labelle design", "brightline trading",
        "central marketplace", "oak & iron partners",
    )),
    ("Contractor & Staffing", (
        "contractor", "temp staffing", "field service", "project staffing",
        "project support", "leasehold improvement", "construction", "hvac service",
        "commercial hvac",
    )),
    ("Cash Management", (
        "atm withdrawal", "cash withdrawal", "petty cash", "change fund", "cash fund",
        "branch cash", "cash services",
    )),
    ("Employee Reimbursements", ("reimbursement", "travel expense")),
    ("Vendor Payments", (
        "outward payments", "outward fast payments", "ach payment", r"check \d+",
        "wire out", "northstar metals", "triangle tooling",
    )),
    ("Loans & Financing", (
        "loan payment", "loan proceeds", "line of credit", "term loan", "sba loan",
        "business loan", "equipment financing", "merchant advance",
    )),
    ("Marketing & Advertising", (
        "advertising", "marketing", "google ads", "facebook ads", "linkedin ads",
        "social media", "seo ",
    )),
    ("Fuel & Fleet", ("fuel", "gas station", "gasoline", "diesel")),
    ("Owner Transactions", (
        "owner draw", "distribution", "dividend", "capital contribution",
        "equity injection", " rubio ", "^rubio$",
    )),
    ("Financial Income", (
        "interest earned", "interest income", "bank interest", "investment income",
    )),
    ("Internal Transfers", (
        "transfer to", "transfer from", "internal transfer", "between accounts",
    )),
)

# Words used by the corrections after the first classification.
FIX_TAX_WORDS = ("irs", "internal revenue", "tax payment", "federal tax", "state tax")
FIX_OUTWARD_WORDS = ("outward", "ach payment -")
FIX_RETAIL_WORDS = ("retail", "wholesale")
FIX_CUSTOMER_WORDS = ("customer payment", "harbor wholesale", "oak & iron", "wire incoming", "wholesale")
FIX_SETTLEMENT_WORDS = ("settlement", "stripe payout", "square deposit")
FIX_FEE_WORDS = ("fee", "charge", "processing")


#: Signs by which a phrase is a pattern; any other phrase is searched letter by letter.
PATTERN_SIGNS = re.compile(r"[\\^$.|?*+()\[\]{}\t\n\r\f\v]|  ")


def phrase_pattern(phrases) -> str:
    """One alternation for a list of phrases; a space matches any run of white space."""
    return "|".join(p.replace(" ", r"\s+") for p in phrases)


def grouped_pattern(phrases) -> str:
    """``phrase_pattern`` with the alternatives grouped by first character.

    Matches the same texts.  A look-ahead skips the positions where no phrase can
    start, which halves the cost of a long list.
    """
    firsts = sorted({p[0] for p in phrases})
    if any(not c.isalnum() for c in firsts):
        return phrase_pattern(phrases)
    groups = (
        f"{c}(?:{phrase_pattern([p[1:] for p in phrases if p[0] == c])})" for c in firsts
    )
    return f"(?=[{''.join(firsts)}])(?:{'|'.join(groups)})"


# ---------------------------------------------------------------------------
# Screening rules
# ---------------------------------------------------------------------------

RECURRING_CATEGORIES = (
    "Shipping & Logistics", "Utilities & Services", "Bank Fees",
    "Payroll & Benefits", "Taxes & Government", "Rent & Facilities",
)
GROWTH_EXCLUDED_CATEGORIES = (
    "Shipping & Logistics", "Utilities & Services", "Taxes & Government", "Bank Fees",
    "Payroll & Benefits", "Rent & Facilities", "Insurance & Security",
)
DUPLICATE_FEE_PHRASES = ("monthly service charge", "service fee", "maintenance fee", "account fee")
COUNTERPARTY_EXCLUDED_WORDS = (
    "payroll", "irs", "internal revenue", "tax payment",
    "eftps", "utility", "insurance", "health insurance",
)
FIXED_COST_WORDS = ("rent", "lease", "payroll", "salary", "loan payment", "insurance")
WEEKEND_EXCLUDED_WORDS = (
    "ach", "automatic", "recurring", "payroll", "tax payment",
    "eftps", "irs", "internal revenue",
)


@dataclass(frozen=True)
class DuplicateRule:
    amount_tolerance: str = "0.01"
    max_days_apart: int = 3
    min_amount: str = "100.00"
    excluded_categories: tuple = RECURRING_CATEGORIES
    fee_phrases: tuple = DUPLICATE_FEE_PHRASES


@dataclass(frozen=True)
class CounterpartyRule:
    min_amount: str = "50000.00"
    excluded_words: tuple = COUNTERPARTY_EXCLUDED_WORDS


@dataclass(frozen=True)
class RoundAmountRule:
    step: int = 1000
    min_rows_overall: int = 3
    min_rows_per_amount: int = 2
    listed_vendors: int = 2
    listed_ids: int = 5
    fixed_cost_words: tuple = FIXED_COST_WORDS


@dataclass(frozen=True)
class SplitRule:
    min_count: int = 2
    min_total: str = "10000.00"
    large_payment: str = "5000.00"
    listed_sources: int = 3
    # An alert lists every id of its group.  A number shows that many and "(+n more)";
    # its evidence rows are always complete.
    listed_ids: int | None = None


@dataclass(frozen=True)
class WeekendRule:
    floor: str = "25000"
    percentile: str = "0.95"
    percentile_above_rows: int = 20
    collapse_above: int = 3
    listed_ids: int = 15
    listed_top: int = 3
    vendor_chars: int = 25
    excluded_words: tuple = WEEKEND_EXCLUDED_WORDS


@dataclass(frozen=True)
class VelocityRule:
    min_amount: str = "20000.00"
    min_count: int = 5
    listed_ids: int = 10


@dataclass(frozen=True)
class GrowthRule:
    min_dates: int = 30
    min_months: int = 2
    baseline_min: str = "1000.00"
    growth_factor: str = "2.0"
    listed_ids: int = 2
    excluded_categories: tuple = GROWTH_EXCLUDED_CATEGORIES


@dataclass(frozen=True)
class ScreeningConfig:
    duplicate: DuplicateRule = field(default_factory=DuplicateRule)
    counterparty: CounterpartyRule = field(default_factory=CounterpartyRule)
    round_amount: RoundAmountRule = field(default_factory=RoundAmountRule)
    split: SplitRule = field(default_factory=SplitRule)
    weekend: WeekendRule = field(default_factory=WeekendRule)
    velocity: VelocityRule = field(default_factory=VelocityRule)
    growth: GrowthRule = field(default_factory=GrowthRule)


DEFAULT = ScreeningConfig()

# Execution order of the rules; also the order of alert numbers.
RULE_NAMES = (
    "Duplicate Payment",
    "New Counterparty - High Amount",
    "Round Amount Clustering",
    "Split Payments",
    "Weekend Activity",
    "Weekend Activity (Multiple)",
    "High Velocity Outflows",
    "Vendor Concentration Growth",
)


@dataclass(frozen=True)
class IntakeConfig:
    """What a statement's header, dates, balances and descriptions are recognised by."""

    header_scan_rows: int = HEADER_SCAN_ROWS
    opening_scan_rows: int = OPENING_SCAN_ROWS
    closing_scan_rows: int = CLOSING_SCAN_ROWS
    date_words: tuple = DATE_WORDS
    description_words: tuple = DESCRIPTION_WORDS
    balance_words: tuple = BALANCE_WORDS
    debit_markers: tuple = DEBIT_MARKERS
    credit_markers: tuple = CREDIT_MARKERS
    amount_markers: tuple = AMOUNT_MARKERS
    debit_words: tuple = DEBIT_WORDS
    credit_words: tuple = CREDIT_WORDS
    amount_words: tuple = AMOUNT_WORDS
    type_words: tuple = TYPE_WORDS
    opening_words: tuple = OPENING_WORDS
    opening_row_words: tuple = OPENING_ROW_WORDS
    closing_words: tuple = CLOSING_WORDS
    closing_row_words: tuple = CLOSING_ROW_WORDS
    date_formats: tuple = DATE_FORMATS
    category_phrases: tuple = CATEGORY_PHRASES


INTAKE = IntakeConfig()

# analytics
BENFORD_MIN_ROWS = 50
BENFORD_CRITICAL = 15.507
BENFORD_REVIEW_ABOVE = 5.0
CONCENTRATION_TOP = 10
RUNWAY_CAP_DAYS = 999
OTHER_VENDORS = "OTHER (all remaining vendors)"
UNKNOWN_VENDOR = "UNKNOWN"

# Published configuration tables
THRESHOLD_TABLE = (
    ("Duplicate Detection",
     "Same vendor within ±1% amount AND within 3 days (min debit $100)",
     "Allows for minor rounding differences; focuses on material duplicates",
     "Industry practice"),
    ("Split Payments",
     "2+ payments to same vendor on same day; total >$10,000 (flag if any single >$5,000)",
     "Identifies potential approval splitting / policy circumvention patterns",
     "Common approval/reporting thresholds"),
    ("Vendor Concentration Growth",
     "Baseline→latest month spend >2x AND baseline >$1,000",
     "Highlights rapidly increasing dependency on a single vendor over the analysis period",
     "Forensic vendor-risk screening"),
    ("New Counterparty Alert", ">$50,000",
     "Materiality threshold for significant new counterparties",
     "Typical SMB materiality level"),
    ("Round Amount Clustering", "Exact $1,000 increments",
     "Identify potential estimates or manual entries", "Forensic screening"),
    ("Weekend Activity", "Dynamic (p95 debit * 1.25)",
     "Flags unusually large weekend debits (excludes taxes/payroll/recurring)",
     "Run-specific (logged)"),
)
EXCLUSION_TABLE = (
    ("Duplicate Detection",
     "Shipping & Logistics; Utilities & Services; Bank Fees; Payroll & Benefits; "
     "Taxes & Government; Rent & Facilities",
     "Recurring operational payments can repeat amounts."),
    ("Vendor Concentration Growth",
     "Shipping & Logistics; Utilities & Services; Taxes & Government; Bank Fees; "
     "Payroll & Benefits; Rent & Facilities; Insurance & Security",
     "Category concentration may be expected due to contracts or statutory payments."),
    ("New Counterparty Alert",
     "Payroll & Benefits; Taxes & Government; Utilities & Services; Insurance & Security",
     "New vendors are common during business growth and onboarding."),
    ("Weekend Activity",
     "Payroll & Benefits; Taxes & Government; Bank Fees",
     "Scheduled processing and deadlines can post on weekends."),
    ("Round Amount Clustering",
     "Rent & Facilities; Loans & Financing; Payroll & Benefits",
     "Fixed contractual amounts are often exact."),
)
