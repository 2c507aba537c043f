"""SQL for intake, analytics, findings reports, integrity checks and tables."""

from __future__ import annotations

from ledgersieve import config as C
from ledgersieve.sources import fixtures as X
from oracle import rules as Q
from oracle.base import (
    canonical_ctes, keyword_category, listed, money, movements, quoted, strip, text, with_txn,
)


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# --- intake ---------------------------------------------------------------------

START = " ".join(f"WHEN {quoted(b)} THEN {n}" for b, n in X.DATA_START.items())
# Statement rows as the three layouts hold them, plus the lines at the end of BETA and GAMMA.
INTAKE_ROWS = f"""
per_bank AS (SELECT bank, count(*) AS n, max(d) AS last,
                    COALESCE(sum(credit), 0) - COALESCE(sum(debit), 0) AS net FROM stmt GROUP BY bank),
istmt AS (
  SELECT d, description, debit, credit, bank, source_file, source_sheet,
         CAST(source_row - 2 + CASE bank {START} END AS BIGINT) AS source_row FROM stmt
  UNION ALL
  SELECT last, 'Closing balance', NULL, CAST(5000 AS DECIMAL(18,2)), bank, bank || '_statement.csv', 'Sheet1',
         n + {X.DATA_START['BETA']} FROM per_bank WHERE bank = 'BETA'
  UNION ALL
  SELECT DATE '2002-01-01', 'adjustment with no amount', NULL, NULL, bank, bank || '_statement.csv', 'Sheet1',
         n + {X.DATA_START['GAMMA']} FROM per_bank WHERE bank = 'GAMMA'
  UNION ALL
  SELECT DATE '2002-01-02', 'adjustment on both sides', CAST(1 AS DECIMAL(18,2)), CAST(2 AS DECIMAL(18,2)), bank,
         bank || '_statement.csv', 'Sheet1', n + {X.DATA_START['GAMMA']} + 1 FROM per_bank WHERE bank = 'GAMMA'
)"""
BALANCES = """
opening AS (
  SELECT bank || '_statement.csv' AS source_file,
         CAST(CASE bank WHEN 'ALPHA' THEN 10000.00 ELSE -1500.25 END AS DECIMAL(18,2)) AS balance,
         CASE bank WHEN 'ALPHA' THEN 'Sheet1!C2' ELSE 'Sheet1!B1' END AS ref
  FROM per_bank WHERE bank IN ('ALPHA', 'BETA')
),
closing AS (
  SELECT bank || '_statement.csv' AS source_file,
         CAST(CASE bank WHEN 'ALPHA' THEN 10000 + net ELSE 5000 END AS DECIMAL(18,2)) AS balance,
         CASE bank WHEN 'ALPHA' THEN 'Sheet1!B3' ELSE 'Sheet1!R' || CAST(n + 4 AS VARCHAR) END AS ref
  FROM per_bank WHERE bank IN ('ALPHA', 'BETA')
)"""
RECONCILED = """
per_file AS (SELECT source_file, min(d) AS d1, max(d) AS d2, count(*) AS n, COALESCE(sum(credit), 0) AS inflow,
                    COALESCE(sum(debit), 0) AS outflow, sum(amount_signed) AS net FROM txn GROUP BY source_file),
rec AS (
  SELECT f.*, o.balance AS opening, o.ref AS opening_ref, c.balance AS closing, c.ref AS closing_ref,
         o.balance + f.net AS expected, c.balance - (o.balance + f.net) AS delta,
         CASE WHEN c.balance - (o.balance + f.net) IS NULL THEN 'N/A'
              WHEN abs(c.balance - (o.balance + f.net)) < 0.01 THEN 'TRUE' ELSE 'FALSE' END AS reconciles
  FROM per_file f LEFT JOIN opening o USING (source_file) LEFT JOIN closing c USING (source_file)
)"""


def with_intake(body: str, extra: str = "") -> str:
    """Like ``with_txn``, with the transactions of the consolidated grids as ``txn``."""
    more = f",\n{extra}" if extra else ""
    return f"WITH {movements()},\n{INTAKE_ROWS},\n{BALANCES},\n{canonical_ctes('istmt')}{more}\n{body}"


TXN_COLUMNS = (
    f"txn_id, {big('seq')} AS txn_seq, {text('d')} AS date, description, description_clean, vendor_normalized, "
    "CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit, CAST(amount_signed AS DOUBLE) AS amount_signed, "
    f"op AS operation_type, direction, bank, source_file, source_sheet, {big('source_row')} AS source_row")


def file_columns() -> str:
    roles = ("date", "description", "balance", "debit", "credit", "amount", "type")
    layout = {
        "ALPHA": (7, "debit_credit", (0, 1, 4, 2, 3, None, None)),
        "BETA": (3, "amount_signed", (0, 1, None, None, None, 2, None)),
        "GAMMA": (2, "debit_credit", (0, 3, None, 4, 5, None, 1)),
    }
    arms = []
    for bank, (row, kind, positions) in layout.items():
        cols = ", ".join(
            f"CAST({'NULL' if p is None else p} AS BIGINT) AS {r}_column" for r, p in zip(roles, positions))
        arms.append(f"SELECT {quoted(bank)} AS b, {big(row)} AS header_row, {quoted(kind)} AS format_type, {cols}")
    union = " UNION ALL ".join(arms)
    return (f"WITH {movements()}, lay AS ({union}) SELECT DISTINCT source_file, source_sheet, bank, lay.* EXCLUDE (b) "
            "FROM stmt JOIN lay ON bank = b")


#: Lines above and below the rows of a bank's file: at the head, lost behind the rows, kept behind them.
AROUND = {"ALPHA": (5, 2, 0), "BETA": (2, 1, 1), "GAMMA": (1, 0, 2)}


def _around(which: int) -> str:
    return "CASE bank " + " ".join(f"WHEN {quoted(b)} THEN {n[which]}" for b, n in AROUND.items()) + " END"


def first_sheets() -> str:
    """Sheet2 has the odd rows; GAMMA's comes first."""
    return f"""WITH {movements()},
size AS (SELECT bank, source_file, count(*) AS n FROM stmt GROUP BY ALL),
rows AS (
  SELECT source_file, bank, unnest(range(1, n + 1)) + CASE bank WHEN 'ALPHA' THEN 7 WHEN 'BETA' THEN 3 ELSE 2 END AS r FROM size
  UNION ALL SELECT source_file, bank, n + CASE bank WHEN 'ALPHA' THEN 7 WHEN 'BETA' THEN 3 ELSE 2 END + unnest([1, 2]) FROM size
  UNION ALL SELECT source_file, bank, unnest(CASE bank WHEN 'ALPHA' THEN [1, 2, 3, 4, 7] WHEN 'BETA' THEN [1, 3] ELSE [2] END) FROM size
  UNION ALL SELECT 'NOTES_regions.csv', 'NOTES', r_regionkey + 1 FROM region)
SELECT source_file, CASE bank WHEN 'GAMMA' THEN 'Sheet2' ELSE 'Sheet1' END AS source_sheet, count(*) AS n,
       {big('min(r)')} AS low, {big('max(r)')} AS high
FROM rows WHERE bank <> 'GAMMA' OR r % 2 = 1 GROUP BY source_file, bank"""


def reject_reasons() -> str:
    row = lambda file, reason, lines, lost, source: (
        f"SELECT {file} AS source_file, {quoted(reason)} AS reason, {big(lines)} AS lines, {big(lost)} AS lost FROM {source}")
    one = lambda reason, lines, lost, bank: row("source_file", reason, lines, lost, f"(SELECT DISTINCT source_file FROM stmt WHERE bank = {quoted(bank)})")
    customers = lambda turn: f"(SELECT count(*) AS n FROM customer WHERE c_custkey % 8 = {turn}) WHERE n > 0"
    by_bank = "(SELECT bank, count(*) AS n FROM stmt GROUP BY bank)"
    parts = [
        row("source_file", "above the table", _around(0), _around(0), "(SELECT DISTINCT source_file, bank FROM stmt)"),
        one("no date", 1, 1, "ALPHA"), one("unread date", 1, 1, "ALPHA"), one("no description", 1, 1, "BETA"),
        row("'NOTES_regions.csv'", "no header in rows 1-50", "count(*)", "count(*)", "region"),
        row("'DELTA_nations.csv'", "above the table", 1, 1, "(SELECT 1)"), row("'DELTA_nations.csv'", "no amount column", 1, 0, "(SELECT 1)"),
        row("'DELTA_nations.csv'", "no line parsed", 0, 0, "(SELECT 1)"), row("'DELTA_nations.csv'", "unread date", "count(*)", "count(*)", "nation"),
        row("'EPSILON_customers.csv'", "above the table", 1, 1, "(SELECT 1)"),
        *(row("'EPSILON_customers.csv'", reason, "n", "n", customers(turn)) for turn, reason in enumerate(("no date", "unread date", "no description"))),
        row("'payments/bank=' || bank", "no header in rows 1-50", "n", "n", by_bank), row("'payments/bank=' || bank", "quote never closed", 1, 0, by_bank),
        row("'nations'", "no header in rows 1-50", "count(*)", "count(*)", "nation"),
        row("'nations'", "unreadable text", "count(*)", 0, "nation WHERE n_nationkey % 5 = 0"), row("'none'", "empty file", 0, 0, "(SELECT 1)")]
    return f"WITH {movements()}\n" + "\nUNION ALL ".join(parts)


def line_balance() -> str:
    return f"""WITH {movements()}, size AS (SELECT bank, source_file, count(*) AS n FROM stmt GROUP BY ALL),
found AS (
  SELECT source_file, n + {_around(0)} + 2 AS lines, n + {_around(2)} AS kept FROM size
  UNION ALL SELECT 'NOTES_regions.csv', count(*), 0 FROM region
  UNION ALL SELECT 'DELTA_nations.csv', count(*) + 1, 0 FROM nation
  UNION ALL SELECT 'EPSILON_customers.csv', count(*) + 1, count(*) FILTER (c_custkey % 8 > 2) FROM customer)
SELECT source_file, {big('lines')} AS lines, {big('kept')} AS kept, {big('lines - kept')} AS lost, true AS balanced FROM found"""


REC_ROWS = [
    ("Statement period (from Transactions)", "CAST(d1 AS VARCHAR) || ' — ' || CAST(d2 AS VARCHAR)", "'Transactions'"),
    ("Transactions count", "CAST(n AS VARCHAR)", "'Transactions'"),
    ("Total inflows (Credit)", "CAST(inflow AS VARCHAR)", "'Transactions'"),
    ("Total outflows (Debit)", "CAST(outflow AS VARCHAR)", "'Transactions'"),
    ("Net cash flow (Credit - Debit)", "CAST(net AS VARCHAR)", "'Transactions'"),
    ("Opening balance (reported)", "CAST(opening AS VARCHAR)", "COALESCE(opening_ref, 'N/A')"),
    ("Closing balance (reported)", "CAST(closing AS VARCHAR)", "COALESCE(closing_ref, 'N/A')"),
    ("Closing balance (expected)", "CAST(expected AS VARCHAR)", "'Derived'"),
    ("Delta (reported - expected)", "CAST(delta AS VARCHAR)", "'Derived'"),
    ("Reconciles (abs(delta)<0.01)", "reconciles", "'Derived'"),
]

# --- analytics ----------------------------------------------------------------------

BENFORD = """
dig AS (SELECT CAST(substring(CAST(debit AS VARCHAR), 1, 1) AS INTEGER) AS g FROM txn WHERE debit > 0),
ben AS (
  SELECT k AS first_digit, (SELECT count(*) FROM dig) AS sample_size, (SELECT count(*) FROM dig WHERE g = k) AS observed,
         log10(1 + 1.0 / k) * 100 AS expected_pct,
         (SELECT count(*) FROM dig WHERE g = k) / CAST((SELECT count(*) FROM dig) AS DOUBLE) * 100 AS actual_pct
  FROM range(1, 10) r(k) WHERE (SELECT count(*) FROM dig) >= 50
)"""
CASH = """
cf AS (
  SELECT COALESCE(sum(credit), 0) AS total_inflow, COALESCE(sum(debit), 0) AS total_outflow,
         count(*) AS transaction_count, min(d) AS d1, max(d) AS d2, NULLIF(date_diff('day', min(d), max(d)), 0) AS days,
         COALESCE(sum(credit), 0) - COALESCE(sum(debit), 0) AS net FROM txn
),
cash AS (
  SELECT *, CAST(total_inflow AS DOUBLE) / days AS a_in, CAST(total_outflow AS DOUBLE) / days AS a_out,
         CAST(total_outflow AS DOUBLE) / days - CAST(total_inflow AS DOUBLE) / days AS burn FROM cf
)"""
CASH_COLUMNS = (
    f"{dbl('total_inflow')} AS total_inflow, {dbl('total_outflow')} AS total_outflow, transaction_count, "
    f"{text('d1')} AS first_date, {text('d2')} AS last_date, {dbl('net')} AS net_cash_flow, {big('days')} AS period_days, "
    "round(a_in, 6) AS avg_daily_inflow, round(a_out, 6) AS avg_daily_outflow, round(burn, 6) AS avg_daily_burn, "
    "round(CASE WHEN burn > 0 THEN least(abs(CAST(net AS DOUBLE) / burn), 999.0) END, 6) AS estimated_runway_days")
POSITION = """
pos AS (SELECT cash.*, (SELECT sum(balance) FROM opening) AS bb, (SELECT sum(balance) FROM opening) + net AS eb FROM cash),
posr AS (SELECT *, CASE WHEN burn > 0 AND eb > 0 THEN CAST(eb AS DOUBLE) / burn WHEN eb <= 0 THEN 0.0 END AS rw FROM pos)"""
MONTHS = """
mon AS (SELECT strftime(d, '%Y-%m') AS month, COALESCE(sum(debit), 0) AS outflows, COALESCE(sum(credit), 0) AS inflows,
               count(d) AS transaction_count, COALESCE(sum(credit), 0) - COALESCE(sum(debit), 0) AS net
        FROM txn GROUP BY 1)"""
MONTH_COLUMNS = (f"month, {dbl('outflows')} AS outflows, {dbl('inflows')} AS inflows, transaction_count, "
                 f"{dbl('net')} AS net")
CONCENTRATION = f"""
vs AS (
  SELECT COALESCE(NULLIF({strip('vendor_normalized')}, ''), NULLIF({strip('description_clean')}, ''), 'UNKNOWN') AS vendor,
         COALESCE(sum(debit), 0) AS total_spending FROM txn GROUP BY 1
),
vr AS (SELECT *, row_number() OVER (ORDER BY total_spending DESC, vendor) AS rn FROM vs),
con AS (
  SELECT *, CAST(total_spending AS DOUBLE) / CAST((SELECT sum(total_spending) FROM vs) AS DOUBLE) * 100 AS pct FROM (
    SELECT vendor, total_spending, rn FROM vr WHERE rn <= 10
    UNION ALL
    SELECT {quoted(C.OTHER_VENDORS)}, sum(total_spending), NULL FROM vr WHERE rn > 10 HAVING sum(total_spending) > 0
  ) WHERE (SELECT sum(total_spending) FROM vs) > 0
)"""


def category(direction: str, amount: str) -> str:
    return with_txn(
        f"SELECT op AS category, {dbl(f'sum({amount})')} AS amount, "
        f"round({dbl(f'sum({amount})')} / {dbl(f'(SELECT sum({amount}) FROM txn WHERE direction = {quoted(direction)})')}"
        f", 6) AS share FROM txn WHERE direction = {quoted(direction)} GROUP BY op")


def metrics(source: str) -> str:
    """Dashboard figures of a transactions CTE as (section, key, metric, value)."""
    t = source
    ben_n = f"(SELECT count(*) FROM {t} WHERE debit > 0)"
    ob = "(SELECT sum(balance) FROM opening)"
    days = f"(SELECT NULLIF(date_diff('day', min(d), max(d)), 0) FROM {t})"
    s = lambda c: f"(SELECT COALESCE(sum({c}), 0) FROM {t})"
    cash = {
        "Total Transactions": f"(SELECT count(*) FROM {t})", "Beginning Balance": ob,
        "Ending Balance": f"{ob} + {s('credit')} - {s('debit')}",
        "Total Inflows": s("credit"), "Total Outflows": s("debit"), "Net Cash Flow": f"{s('credit')} - {s('debit')}",
        "Avg Daily Inflow": f"round({dbl(s('credit'))} / {days}, 2)",
        "Avg Daily Outflow": f"round({dbl(s('debit'))} / {days}, 2)",
        "Daily Burn Rate": f"round({dbl(s('debit'))} / {days} - {dbl(s('credit'))} / {days}, 2)",
    }
    parts = [f"SELECT 'Cash Flow Metrics' AS section, {quoted(k)} AS key, 'Value' AS metric, {dbl(v)} AS value"
             for k, v in cash.items()]
    month = "strftime(d, '%Y-%m')"
    for m, e in (("Inflows", "COALESCE(sum(credit), 0)"), ("Outflows", "COALESCE(sum(debit), 0)"),
                 ("Net", "COALESCE(sum(credit), 0) - COALESCE(sum(debit), 0)")):
        parts.append(f"SELECT 'Monthly Trends', {month}, {quoted(m)}, {dbl(e)} FROM {t} GROUP BY {month}")
    parts.append(
        f"SELECT 'Benford', CAST(k AS VARCHAR), 'Actual % (Debit)', round((SELECT count(*) FROM {t} WHERE debit > 0 AND "
        f"substring(CAST(debit AS VARCHAR), 1, 1) = CAST(k AS VARCHAR)) / {dbl(ben_n)} * 100, 1) "
        f"FROM range(1, 10) r(k) WHERE {ben_n} >= 50")
    for m, e in (("Total Spending", dbl("total_spending")), ("% of Total", "round(pct / 100, 3)")):
        parts.append(f"SELECT 'Vendor Concentration', vendor, {quoted(m)}, {e} FROM con_{t}")
    for section, direction, amount in (
            ("Category Outflows", "Outflow", "debit"), ("Category Inflows", "Inflow", "credit")):
        parts.append(f"SELECT {quoted(section)}, op, 'Amount', {dbl(f'sum({amount})')} FROM {t} "
                     f"WHERE direction = {quoted(direction)} GROUP BY op")
    con = CONCENTRATION
    for name in ("vs", "vr", "con"):
        con = con.replace(f"\n{name} AS (", f"\n{name}_{t} AS (").replace(f"FROM {name})", f"FROM {name}_{t})")
    con = con.replace("FROM vr WHERE", f"FROM vr_{t} WHERE").replace("FROM vs)", f"FROM vs_{t})")
    con = con.replace("FROM txn GROUP", f"FROM {t} GROUP")
    return con + f",\nmet_{t} AS (" + "\nUNION ALL ".join(parts) + ")"


def comparison() -> str:
    """Dashboard of the statement view against the consolidated grids."""
    first = canonical_ctes("stmt")
    for name in ("cleaned", "kw", *[f"fix{i}" for i in range(7)], "txn"):
        first = first.replace(f"\n{name} AS ", f"\np_{name} AS ").replace(f"FROM {name})", f"FROM p_{name})")
        first = first.replace(f"FROM {name}\n)", f"FROM p_{name}\n)")
    tol = ("CASE WHEN section = 'Cash Flow Metrics' AND key = 'Total Transactions' THEN 0 "
           "WHEN section = 'Cash Flow Metrics' AND key IN ('Avg Daily Inflow', 'Avg Daily Outflow', 'Daily Burn Rate') "
           "THEN 0.02 WHEN section = 'Benford' THEN 0.2 WHEN metric = '% of Total' THEN 0.001 ELSE 0.01 END")
    return with_intake(f"""
SELECT section, key, metric, round(p, 4) AS published, round(r, 4) AS recomputed, round(p - r, 4) AS delta,
       CASE WHEN p - r IS NULL THEN 'N/A' WHEN abs(p - r) <= {tol} THEN 'OK' ELSE 'MISMATCH' END AS status
FROM (SELECT section, key, metric, a.value AS p, b.value AS r
      FROM met_p_txn a FULL JOIN met_txn b USING (section, key, metric))""",
                       f"{first},\n{metrics('p_txn')},\n{metrics('txn')}")


# --- findings reports and integrity ------------------------------------------------------

DAMAGED_TXN = """
bad AS (
  SELECT CASE WHEN op = 'Software & IT' THEN NULL WHEN op = 'Insurance & Security' THEN 'TXN_00001' ELSE txn_id END AS id,
         COALESCE(CASE WHEN op = 'Rent & Facilities' THEN -debit ELSE debit END, 0) AS debit,
         COALESCE(CASE WHEN op = 'Payroll & Benefits' THEN debit ELSE credit END, 0) AS credit,
         CASE WHEN op = 'Taxes & Government' THEN 'Inflow' WHEN op = 'Card Settlement (Income)' THEN 'Outflow'
              ELSE direction END AS direction,
         CASE WHEN op = 'Shipping & Logistics' THEN NULL ELSE d END AS d
  FROM txn
),
chk AS (
  SELECT 'missing txn id' AS check_name, 'error' AS severity, count(*) FILTER (id IS NULL) AS n FROM bad
  UNION ALL SELECT 'txn id not unique', 'error', count(*) - count(DISTINCT COALESCE(id, '')) FROM bad
  UNION ALL SELECT 'negative debit or credit', 'error', count(*) FILTER (debit < 0 OR credit < 0) FROM bad
  UNION ALL SELECT 'debit and credit both filled', 'error', count(*) FILTER (debit > 0 AND credit > 0) FROM bad
  UNION ALL SELECT 'direction of a debit', 'warning', count(*) FILTER (debit > 0 AND NOT contains(lower(direction), 'out')) FROM bad
  UNION ALL SELECT 'direction of a credit', 'warning', count(*) FILTER (credit > 0 AND NOT contains(lower(direction), 'in')) FROM bad
  UNION ALL SELECT 'date missing', 'warning', count(*) FILTER (d IS NULL) FROM bad
)"""
LINKS = """
lk AS (
  SELECT alert_seq, alert_id, category, vendor, date_1, date_2, evidence, txn_ids,
         string_split(l, ':')[1] AS grp, string_split(l, ':')[2] AS txn_id
  FROM (SELECT *, unnest(string_split(links, ', ')) AS l FROM fnd)
)"""
# The damage of ``damaged_findings``: links, dates and evidence changed per vendor purpose.
DAMAGED_FND = """
dam AS (
  SELECT alert_id, category, vendor,
         CASE WHEN category = 'Vendor Concentration Growth' AND vendor LIKE 'WHOLESALE%' THEN CAST(date_1 - INTERVAL 1 MONTH AS DATE)
              WHEN category = 'Vendor Concentration Growth' AND vendor LIKE 'RETAIL%' THEN NULL ELSE date_1 END AS date_1,
         CASE WHEN category = 'Duplicate Payment' AND vendor LIKE 'MISC%' THEN CAST(date_1 + INTERVAL 9 DAY AS DATE) ELSE date_2 END AS date_2,
         CASE WHEN category = 'Duplicate Payment' AND vendor LIKE 'CONSULTING%' THEN replace(evidence, 'tolerance', 'range')
              WHEN category = 'Duplicate Payment' AND vendor LIKE 'RETAIL%' THEN replace(evidence, '$', 'EUR ') ELSE evidence END AS evidence,
         txn_ids
  FROM fnd
),
dlk AS (
  SELECT alert_id, category, grp,
         CASE WHEN vendor LIKE 'HOSTING%' AND NOT (category IN ('Duplicate Payment', 'Vendor Concentration Growth')
                   AND (vendor LIKE 'WHOLESALE%' OR vendor LIKE 'CONSULTING%'))
              THEN replace(txn_id, 'TXN_', 'TXN_X') ELSE txn_id END AS txn_id
  FROM (SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY strpos(txn_ids, txn_id)) AS i FROM lk)
  WHERE NOT (category = 'Duplicate Payment' AND vendor LIKE 'WHOLESALE%' AND i > 1)
    AND NOT (category = 'Vendor Concentration Growth' AND vendor LIKE 'CONSULTING%' AND grp <> 'Latest')
)"""
GROWTH_ISSUES = """
g AS (SELECT *, strftime(date_1, '%Y-%m') AS base, strftime(date_2, '%Y-%m') AS late,
             regexp_extract(txn_ids, 'Baseline (\\d{4}-\\d{2})', 1) AS sb, regexp_extract(txn_ids, 'Latest (\\d{4}-\\d{2})', 1) AS sl
      FROM dam WHERE category = 'Vendor Concentration Growth'),
gx AS (SELECT k.*, g.base, g.late, strftime(t.d, '%Y-%m') AS m FROM dlk k JOIN g USING (alert_id) LEFT JOIN txn t USING (txn_id)
       WHERE g.date_1 IS NOT NULL AND g.date_2 IS NOT NULL),
iss AS (
  SELECT 'growth dates missing' AS check_name, alert_id, NULL AS detail FROM g WHERE date_1 IS NULL OR date_2 IS NULL
  UNION ALL SELECT 'growth evidence months', alert_id, base || ' & ' || late FROM g
    WHERE NOT (contains(evidence, base) AND contains(evidence, late))
  UNION ALL SELECT 'growth baseline segment month', alert_id, sb FROM g WHERE sb <> '' AND sb <> base
  UNION ALL SELECT 'growth latest segment month', alert_id, sl FROM g WHERE sl <> '' AND sl <> late
  UNION ALL SELECT 'growth baseline ids missing', alert_id, NULL FROM g
    WHERE alert_id NOT IN (SELECT alert_id FROM dlk WHERE grp = 'Baseline')
  UNION ALL SELECT 'growth latest ids missing', alert_id, NULL FROM g
    WHERE alert_id NOT IN (SELECT alert_id FROM dlk WHERE grp = 'Latest')
  UNION ALL SELECT 'growth id unknown', alert_id, txn_id FROM gx WHERE m IS NULL
  UNION ALL SELECT 'growth id in other month', alert_id, txn_id || ' ' || m FROM gx
    WHERE m <> CASE WHEN grp = 'Baseline' THEN base ELSE late END
)"""
DUPLICATE_ISSUES = f"""
p AS (SELECT f.alert_id, f.evidence, abs(date_diff('day', f.date_1, f.date_2)) AS days,
             count(k.txn_id) AS ids, count(*) FILTER (t.txn_id IS NULL) AS unknown,
             count(*) FILTER (NOT contains(f.evidence, {money('COALESCE(t.debit, 0)')})) AS unnamed
      FROM dam f LEFT JOIN dlk k USING (alert_id) LEFT JOIN txn t ON t.txn_id = k.txn_id
      WHERE f.category = 'Duplicate Payment' GROUP BY ALL),
ok AS (SELECT *, CAST(regexp_extract(evidence, '(\\d+)\\s*day\\(s\\)\\s*apart', 1) AS INTEGER) AS said
       FROM p WHERE ids = 2 AND unknown = 0),
iss AS (
  SELECT 'duplicate not two ids' AS check_name, alert_id, CAST(ids AS VARCHAR) AS detail FROM p WHERE ids <> 2
  UNION ALL SELECT 'duplicate id unknown', alert_id, CAST(unknown AS VARCHAR) FROM p WHERE ids = 2 AND unknown > 0
  UNION ALL SELECT 'duplicate amounts not named', alert_id, evidence FROM ok WHERE unnamed > 0
  UNION ALL SELECT 'duplicate tolerance not named', alert_id, evidence FROM ok WHERE NOT contains(lower(evidence), 'tolerance')
  UNION ALL SELECT 'duplicate days differ', alert_id, CAST(said AS VARCHAR) || ' ' || CAST(days AS VARCHAR) FROM ok WHERE said <> days
  UNION ALL SELECT 'duplicate days too far', alert_id, CAST(days AS VARCHAR) FROM ok WHERE days > 3
)"""
ISSUE_SELECT = "SELECT check_name, 'warning' AS severity, alert_id, detail, CAST(1 AS BIGINT) AS n FROM iss"


def evidence(calendar: str) -> str:
    return Q.findings_query(
        "SELECT alert_seq, alert_id, category, vendor, grp, lk.txn_id, "
        f"{text('t.d')} AS txn_date, {dbl('t.debit')} AS debit, {dbl('t.credit')} AS credit, t.bank, t.src AS source "
        "FROM lk LEFT JOIN txn t ON t.txn_id = lk.txn_id", calendar, LINKS)


def alert_links(calendar: str) -> str:
    """Every payment behind an alert, whether the alert names it or not."""
    by_rule = lambda n, source, on, group="'Related'", id="t.txn_id": (
        f"SELECT f.alert_seq, {group} AS grp, {id} AS txn_id FROM fnd f JOIN {source} t ON {on} WHERE f.rule_no = {n}")
    parts = [
        "SELECT alert_seq, grp, txn_id FROM lk SEMI JOIN (SELECT alert_seq FROM fnd WHERE rule_no IN (1, 2, 5)) USING (alert_seq)",
        by_rule(3, "ra", "t.debit = f.amount"), by_rule(4, "txn", "t.debit > 0 AND t.d = f.date_1 AND t.vk = f.vendor"),
        by_rule(6, "wh", "true"), by_rule(7, "txn", "t.debit > 20000 AND t.d = f.date_1"),
        *(by_rule(8, "gr", f"t.vk = f.vendor AND t.m = strftime(f.{d}, '%Y-%m')", quoted(g)) for g, d in (("Baseline", "date_1"), ("Latest", "date_2")))]
    return Q.findings_query(
        "SELECT f.alert_seq, f.alert_id, f.category, a.grp, a.txn_id, l.txn_id IS NOT NULL AS listed FROM every a "
        "JOIN fnd f USING (alert_seq) LEFT JOIN (SELECT DISTINCT alert_seq, grp, txn_id FROM lk) l "
        "ON l.alert_seq = a.alert_seq AND l.grp = a.grp AND l.txn_id = a.txn_id",
        calendar, LINKS + ",\nevery AS (" + "\nUNION ALL ".join(parts) + ")")


ANCHOR = "COALESCE(anchor_date, greatest(date_1, date_2))"


def calculation_rows(row_sql) -> str:
    return with_txn(" UNION ALL ".join(row_sql), extra=Q.weekend_ctes())


def fixed2(x: str) -> str:
    return f"CAST(CAST(round({x}, 2) AS DECIMAL(24,2)) AS VARCHAR)"


def thresholds() -> str:
    rows = [
        f"SELECT {big(i)} AS line, {quoted(a)} AS rule, {quoted(b)} AS threshold, {quoted(c)} AS rationale, "
        f"{quoted(d)} AS source" for i, (a, b, c, d) in enumerate(C.THRESHOLD_TABLE, 1)]
    rows += [
        f"SELECT {big(7)}, 'RUN-SPECIFIC: p95_debit', {fixed2('p95')}, '95th percentile of debit amounts', "
        "'Computed from Transactions' FROM rs",
        f"SELECT {big(8)}, 'RUN-SPECIFIC: weekend_threshold', {fixed2('thr')}, 'Weekend debit alert threshold', "
        "'Computed from Transactions' FROM rs"]
    return calculation_rows(rows)


def calculations() -> str:
    return calculation_rows([
        f"SELECT 'p95_debit (outflows)' AS parameter, COALESCE({fixed2('p95')}, 'N/A (n<=20)') AS value, "
        "'Quantile(0.95) of Debit > 0 in Transactions' AS how_to_verify, 'n=' || CAST(n AS VARCHAR) AS notes FROM rs",
        f"SELECT 'weekend_threshold', {fixed2('thr')}, 'max(25000, p95_debit) if n>20 else 25000', '' FROM rs",
        "SELECT 'weekend_threshold_floor', '25000', 'Hard floor used in weekend rule', '' FROM rs"])


def queries() -> dict[str, str]:
    keys = f"COALESCE(NULLIF({strip('vendor_normalized')}, ''), 'UNKNOWN')"
    blank = "CASE WHEN op = 'Payroll & Benefits' THEN NULL ELSE NULLIF(" + strip("vendor_normalized") + ", '') END"
    names = ", ".join(f"({i}, {quoted(n)})" for i, n in enumerate(C.RULE_NAMES, 1) if n != C.RULE_NAMES[5])
    typed = keyword_category("lower(descr) || ' ' || lower(c_mktsegment)")
    out = {
        # text and classification
        "cleaned_text": with_txn("SELECT txn_id, description, description_clean, vendor_normalized FROM txn"),
        "vendor_keys": with_txn(
            f"SELECT {keys} AS vendor_key, count(*) AS n, {dbl('sum(debit)')} AS debit, {dbl('sum(credit)')} AS credit "
            "FROM txn GROUP BY 1"),
        "concentration_keys": with_txn(
            f"SELECT COALESCE({blank}, NULLIF({strip('description_clean')}, ''), 'UNKNOWN') AS vendor_key, count(*) AS n "
            "FROM txn GROUP BY 1"),
        "source_pointers": with_txn("SELECT txn_id, src AS source FROM txn"),
        "keyword_categories": with_txn(f"SELECT txn_id, {keyword_category('description')} AS category FROM txn"),
        "categories_with_type": (
            f"SELECT {typed} AS category, count(*) AS n, {dbl('sum(credit)')} AS credit FROM (SELECT 'Order of ' || c_name AS descr, "
            "c_mktsegment, CAST(o_totalprice AS DECIMAL(18,2)) AS credit FROM orders JOIN customer "
            "ON o_custkey = c_custkey) GROUP BY 1"),
        "category_corrections": with_txn(
            f"SELECT {keyword_category('description')} AS category, op AS operation_type, direction, count(*) AS n, "
            f"{dbl('sum(amount_signed)')} AS amount FROM txn GROUP BY 1, 2, 3"),
        "fallback_ids": with_txn(f"SELECT source_file, source_sheet, {big('source_row')} AS source_row, txn_id FROM txn"),
        # analytics
        "benford": with_txn(
            f"SELECT {big('first_digit')} AS first_digit, sample_size, observed, round(expected_pct, 6) AS expected_pct, "
            "round(actual_pct, 6) AS actual_pct, round(actual_pct - expected_pct, 6) AS deviation_pct, "
            "CASE WHEN abs(actual_pct - expected_pct) > 5 THEN 'Review' ELSE 'OK' END AS note FROM ben", extra=BENFORD),
        "benford_test": with_txn(
            "SELECT max(sample_size) AS sample_size, round(sum((observed - expected_pct / 100 * sample_size) ** 2 "
            "/ (expected_pct / 100 * sample_size)), 6) AS chi_square, sum((observed - expected_pct / 100 * sample_size) ** 2 "
            "/ (expected_pct / 100 * sample_size)) < 15.507 AS passes FROM ben HAVING count(*) > 0", extra=BENFORD),
        "cash_flow": with_txn(f"SELECT {CASH_COLUMNS} FROM cash", extra=CASH),
        "cash_position": with_txn(
            f"SELECT {CASH_COLUMNS}, {dbl('bb')} AS beginning_balance, {dbl('eb')} AS ending_balance, "
            "round(rw, 6) AS runway_days, "
            "CASE WHEN eb < 0 THEN 'OVERDRAFT - Account overdrawn' WHEN eb >= 0 THEN 'Final account balance' END "
            "AS ending_comment, CASE WHEN rw = 0 THEN 'No runway - account at or below zero' WHEN rw < 30 THEN "
            "'URGENT - Less than 1 month of cash remaining' WHEN rw < 90 THEN "
            "'Days until funds depleted (at current burn rate)' WHEN rw IS NOT NULL THEN 'Healthy cash runway' END "
            "AS runway_comment FROM posr", extra=f"{INTAKE_ROWS},\n{BALANCES},\n{CASH},\n{POSITION}"),
        "monthly_totals": with_txn(f"SELECT {MONTH_COLUMNS} FROM mon", extra=MONTHS),
        "monthly_trend": with_txn(
            f"SELECT {MONTH_COLUMNS}, CASE WHEN lag(mon.net) OVER (ORDER BY month) IS NULL THEN '—' "
            "WHEN mon.net > lag(mon.net) OVER (ORDER BY month) THEN '↑ Improving' "
            "WHEN mon.net < lag(mon.net) OVER (ORDER BY month) THEN '↓ Worsening' ELSE '→ Stable' END AS trend FROM mon",
            extra=MONTHS),
        "vendor_concentration": with_txn(
            f"SELECT vendor, {dbl('total_spending')} AS total_spending, round(pct, 6) AS percentage, "
            "CASE WHEN rn IS NULL THEN 'N/A' WHEN pct > 25 THEN 'HIGH' WHEN pct > 15 THEN 'MEDIUM' "
            "WHEN pct > 10 THEN 'MODERATE' ELSE 'LOW' END AS risk_level FROM con", extra=CONCENTRATION),
        "category_outflows": category("Outflow", "debit"),
        "category_inflows": category("Inflow", "credit"),
        "category_summary": with_txn(
            f"SELECT op AS operation_type, {dbl('COALESCE(sum(debit), 0)')} AS debit, "
            f"{dbl('COALESCE(sum(credit), 0)')} AS credit FROM txn GROUP BY op"),
        "business_profile": with_txn(
            "SELECT count(*) AS transaction_count, date_diff('day', min(d), max(d)) AS period_days, "
            f"round({dbl('sum(debit)')} / count(debit), 6) AS average_debit FROM txn"),
        "transactions_per_file": with_txn("SELECT source_file, count(*) AS transactions FROM txn GROUP BY source_file"),
        "total_check": with_txn(
            f"SELECT {dbl('sum(credit) - sum(COALESCE(credit, 0))')} AS inflow_difference, "
            f"{dbl('sum(debit) - sum(COALESCE(debit, 0))')} AS outflow_difference, "
            "abs(sum(credit) - sum(COALESCE(credit, 0))) > 0.01 OR abs(sum(debit) - sum(COALESCE(debit, 0))) > 0.01 "
            "AS validation_error FROM txn"),
        # findings reports
        "priority_counts": Q.findings_query(
            "SELECT p AS priority, (SELECT count(*) FROM fnd WHERE priority = p) AS alerts "
            "FROM (VALUES ('P1'), ('P2'), ('P3')) v(p)"),
        "flagged_amounts": Q.findings_query(
            f"SELECT count(*) AS alerts, {dbl('COALESCE(sum(amount) FILTER (paid), 0)')} AS flagged_amount, "
            f"{dbl('COALESCE(sum(amount) FILTER (grown), 0)')} AS growth_delta, {dbl('max(tot)')} AS total_outflows, "
            f"round({dbl('COALESCE(sum(amount) FILTER (paid), 0)')} / {dbl('max(tot)')} * 100, 6) AS flagged_pct "
            "FROM (SELECT *, (SELECT sum(debit) FROM txn) AS tot, regexp_matches(lower(amount_type), "
            "'transaction amount|total paid|total amount') AS paid, regexp_matches(lower(amount_type), 'growth|delta') "
            "AS grown FROM fnd)", "folded"),
        "top_categories": Q.findings_query(
            f"SELECT category, {dbl('sum(amount)')} AS amount FROM fnd GROUP BY category "
            "ORDER BY sum(amount) DESC, category LIMIT 3"),
        "rule_coverage": Q.findings_query(
            f"SELECT {big('i')} AS rule_no, r AS rule, (SELECT count(*) FROM fnd WHERE category = r OR "
            "(r = 'Weekend Activity' AND category LIKE 'Weekend%')) AS alerts "
            f"FROM (VALUES {names}) v(i, r)"),
        "alerts_table": Q.findings_query(
            "SELECT alert_id, priority, category, severity, substring(vendor, 1, 50) AS vendor, "
            f"{dbl('round(amount, 2)')} AS amount, amount_type, substring(bank, 1, 20) AS bank, "
            "substring(operation_type, 1, 25) AS operation_type, evidence, substring(txn_ids, 1, 200) AS txn_ids, "
            f"next_step, {text(ANCHOR)} AS anchor_date FROM fnd", "folded"),
        "evidence_index": evidence("actual"),
        "evidence_index_folded": evidence("folded"),
        "alert_links": alert_links("actual"),
        "alert_links_folded": alert_links("folded"),
        # integrity
        "transaction_issues": with_txn(
            "SELECT check_name, severity, CAST(NULL AS VARCHAR) AS alert_id, CAST(NULL AS VARCHAR) AS detail, n "
            "FROM chk WHERE n > 0", extra=DAMAGED_TXN),
        "unknown_references": Q.findings_query(
            "SELECT 'unknown txn id' AS check_name, 'error' AS severity, alert_id, txn_id AS detail, CAST(1 AS BIGINT) AS n "
            "FROM dlk WHERE txn_id NOT IN (SELECT txn_id FROM txn)", "folded", f"{LINKS},{DAMAGED_FND}"),
        "growth_issues": Q.findings_query(ISSUE_SELECT, "folded", f"{LINKS},{DAMAGED_FND},{GROWTH_ISSUES}"),
        "duplicate_issues": Q.findings_query(ISSUE_SELECT, "actual", f"{LINKS},{DAMAGED_FND},{DUPLICATE_ISSUES}"),
        "metric_comparison": comparison(),
        # intake
        "text_grid": with_txn(
            f"SELECT count(*) AS lines, count(d) AS dates, {dbl('sum(debit)')} AS debit, {dbl('sum(credit)')} AS credit, "
            "CAST(0 AS BIGINT) AS files_with_gaps FROM txn"),
        "file_columns": file_columns(),
        "rejected_files": "SELECT DISTINCT 'NOTES_regions.csv' AS source_file, 'Sheet1' AS source_sheet, "
                          "'no header in rows 1-50' AS reason FROM region",
        "quoted_records": with_txn(
            f"SELECT {text('d')} AS date, CASE WHEN seq % 10 = 0 THEN replace(description, ' ', chr(10)) ELSE description END AS description, "
            f"{dbl('debit')} AS debit, {dbl('credit')} AS credit FROM txn"),
        "first_sheets": first_sheets(),
        "reject_reasons": reject_reasons(),
        "line_balance": line_balance(),
        "intake_summary": with_intake(
            "SELECT source_file, count(*) AS kept, CAST(CASE bank WHEN 'ALPHA' THEN 2 WHEN 'BETA' THEN 1 ELSE 0 END AS BIGINT) "
            "AS removed, count(*) FILTER (debit IS NOT NULL AND credit IS NOT NULL) AS both_filled, "
            "count(*) FILTER (debit IS NULL AND credit IS NULL) AS neither_filled FROM txn GROUP BY source_file, bank"),
        "intake_transactions": with_intake(f"SELECT {TXN_COLUMNS} FROM txn"),
        "merged_layouts": with_txn(
            f"SELECT source_file, count(*) AS n, {dbl('sum(debit)')} AS debit, {dbl('sum(credit)')} AS credit, "
            "count(*) FILTER (credit IS NULL) AS without_credit FROM txn GROUP BY source_file"),
        "opening_balances": with_intake(f"SELECT source_file, {dbl('balance')} AS balance, ref FROM opening"),
        "closing_balances": with_intake(f"SELECT source_file, {dbl('balance')} AS balance, ref FROM closing"),
        "first_rows": with_txn(
            f"SELECT source_file, source_sheet, {big('source_row')} AS source_row, txn_id FROM txn "
            "QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY seq) = 1"),
        "reconciliation": with_intake(
            f"SELECT source_file, {text('d1')} AS first_date, {text('d2')} AS last_date, n AS transactions, "
            + ", ".join(f"{dbl(c)} AS {c}" for c in ("inflow", "outflow", "net", "opening", "closing", "expected", "delta"))
            + ", opening_ref, closing_ref, reconciles FROM rec", RECONCILED),
        "reconciliation_rows": with_intake(
            " UNION ALL ".join(
                f"SELECT source_file, {big(i)} AS line, {quoted(m)} AS metric, {v} AS value, {r} AS ref FROM rec"
                for i, (m, v, r) in enumerate(REC_ROWS, 1)), RECONCILED),
        # tables and sinks
        "threshold_table": thresholds(),
        "run_calculations": calculations(),
        "published_months": with_txn(
            f"SELECT strftime(d, '%Y-%m') AS month, count(*) AS n, {dbl('sum(amount_signed)')} AS amount FROM txn "
            "WHERE strftime(d, '%Y-%m') NOT IN (SELECT strftime(d, '%Y-%m') FROM txn WHERE d >= DATE '1997-06-01' AND direction = 'Outflow') "
            "OR (d >= DATE '1997-06-01' AND direction = 'Outflow') GROUP BY 1"),
        "written_months": with_txn(
            f"SELECT strftime(d, '%Y-%m') AS month, count(*) AS n, {dbl('sum(amount_signed)')} AS amount FROM txn GROUP BY 1"),
    }
    out["weekend_few"] = Q.rule_query(Q.weekend_ctes("104970"), Q.WEEKEND_SINGLE)
    return out
