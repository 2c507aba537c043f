"""SQL for the screening rules; every rule yields the finding columns and sort keys."""

from __future__ import annotations

from ledgersieve import config as C
from oracle.base import has, listed, money, quoted, text, with_txn

FIELDS = (
    "priority", "category", "severity", "vendor", "amount", "amount_type", "date_1", "date_2", "anchor_date",
    "bank", "operation_type", "source_loc", "evidence", "txn_ids", "next_step", "risk", "action", "links",
)


def draft(rule_no: int, priority: str, severity: str, source: str, keys: dict, **cols) -> str:
    """SELECT of one rule; missing columns are null."""
    cols = {
        "priority": quoted(priority), "severity": quoted(severity),
        "category": quoted(C.RULE_NAMES[rule_no - 1]), **cols,
    }
    kinds = {"amount": "DECIMAL(38,2)", "date_1": "DATE", "date_2": "DATE", "anchor_date": "DATE"}
    sort = {"k_date": "DATE", "k_vendor": "VARCHAR", "k_amount": "DECIMAL(18,2)", "k_day": "DATE", "k_seq": "BIGINT"}
    parts = [f"{rule_no} AS rule_no"]
    parts += [f"CAST({keys.get(k, 'NULL')} AS {t}) AS {k}" for k, t in sort.items()]
    parts += [f"CAST({cols.get(f, 'NULL')} AS {kinds.get(f, 'VARCHAR')}) AS {f}" for f in FIELDS]
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {source}"


def labelled(ids: str, group: str = "Related") -> str:
    return f"'{group}:' || array_to_string({ids}, ', {group}:')"


def joined(list_expr: str) -> str:
    return f"array_to_string({list_expr}, ', ')"


DUPLICATE_CTES = f"""
du AS (
  SELECT *, lead(vk) OVER w AS n_vk, lead(debit) OVER w AS n_debit, lead(d) OVER w AS n_d,
         lead(txn_id) OVER w AS n_id, lead(src) OVER w AS n_src
  FROM txn WHERE op NOT IN {listed(C.RECURRING_CATEGORIES)}
  WINDOW w AS (ORDER BY vk, debit NULLS LAST, d, seq)
),
dup AS (
  SELECT *, abs(date_diff('day', d, n_d)) AS gap FROM du
  WHERE debit >= 100 AND vk = n_vk AND abs(debit - n_debit) * 100 < debit
    AND abs(date_diff('day', d, n_d)) BETWEEN 1 AND 3
    AND NOT {has('description_clean', C.DUPLICATE_FEE_PHRASES)}
)"""
DUPLICATE = draft(
    1, "P1", "HIGH", "dup", {"k_vendor": "vk", "k_amount": "debit", "k_day": "d", "k_seq": "seq"},
    vendor="vk", amount="debit", amount_type="'Transaction Amount'", date_1="d", date_2="n_d", bank="bank",
    operation_type="op", source_loc="src || ' & ' || n_src",
    evidence=f"'Same vendor, ' || {money('debit')} || ' & ' || {money('n_debit')} || "
             "' (within ±1% tolerance), ' || CAST(gap AS VARCHAR) || ' day(s) apart'",
    txn_ids="txn_id || ', ' || n_id", links="'Related:' || txn_id || ', Related:' || n_id",
    next_step="'Request invoices for both transactions, verify with AP'",
    risk="'Possible duplicate processing or vendor billing error'",
    action="'Verify both payments cleared, investigate with vendor'")

COUNTERPARTY_CTES = f"""
fd AS (SELECT vk, min(d) AS fd FROM txn WHERE debit > 0 GROUP BY vk),
cp AS (
  SELECT t.*, row_number() OVER (PARTITION BY t.vk ORDER BY t.seq) AS rn
  FROM txn t JOIN fd ON t.vk = fd.vk AND t.d = fd.fd
  WHERE t.debit > 50000 AND NOT {has('t.vk', C.COUNTERPARTY_EXCLUDED_WORDS)}
)"""
COUNTERPARTY = draft(
    2, "P1", "HIGH", "cp WHERE rn = 1", {"k_vendor": "vk", "k_seq": "seq"},
    vendor="vk", amount="debit", amount_type="'Transaction Amount'", date_1="d", bank="bank", operation_type="op",
    source_loc="src", evidence=f"'First transaction in dataset window: ' || {money('debit')}",
    txn_ids="txn_id", links="'Related:' || txn_id",
    next_step="'Request supplier onboarding docs: tax form (W-9/W-8 if US; VAT registration if EU/UK), "
              "contract/PO, approval documentation'",
    risk="'No prior transaction history in dataset period'",
    action="'Verify vendor legitimacy and authorization'")

ROUND_CTES = f"""
ra AS (SELECT * FROM txn WHERE debit >= 1000 AND debit % 1000 = 0
       AND NOT {has('description_clean', C.FIXED_COST_WORDS)}),
rv AS (SELECT debit, vk, row_number() OVER (PARTITION BY debit ORDER BY min(seq)) AS rn FROM ra GROUP BY debit, vk),
rvl AS (SELECT debit, string_agg(vk, ', ' ORDER BY rn) AS vendors FROM rv WHERE rn <= 2 GROUP BY debit),
rg AS (
  SELECT debit, count(*) AS n, min(d) AS d1, max(d) AS d2, list(txn_id ORDER BY seq)[1:5] AS ids,
         CASE WHEN count(DISTINCT bank) > 1 THEN 'Multiple' ELSE min(bank) END AS bank,
         CASE WHEN count(DISTINCT op) > 1 THEN 'Multiple' ELSE min(op) END AS op
  FROM ra GROUP BY debit HAVING count(*) >= 2
),
rr AS (SELECT rg.*, vendors FROM rg JOIN rvl USING (debit) WHERE (SELECT count(*) FROM ra) >= 3)"""
ROUND = draft(
    3, "P2", "MEDIUM", "rr", {"k_amount": "debit"},
    vendor="CAST(n AS VARCHAR) || ' transactions: ' || vendors || '...'", amount="debit",
    amount_type="'Transaction Amount'", date_1="d1", date_2="d2", bank="bank", operation_type="op",
    source_loc="'Multiple (' || CAST(n AS VARCHAR) || ' txns)'",
    evidence=f"CAST(n AS VARCHAR) || ' payments of exactly ' || {money('debit')}",
    txn_ids=joined("ids"), links=labelled("ids"),
    next_step="'Request invoices, review for estimation or manual entry'",
    risk="'Unusual clustering of exact amounts (may indicate estimation)'",
    action="'Review for potential manipulation or estimation errors'")

SPLIT_CTES = """
sp AS (
  SELECT d, vk, count(*) AS n, sum(debit) AS total, max(debit) AS largest,
         CASE WHEN count(DISTINCT bank) > 1 THEN 'Multiple' ELSE min(bank) END AS bank,
         CASE WHEN count(DISTINCT op) > 1 THEN 'Multiple' ELSE min(op) END AS op,
         list(txn_id ORDER BY seq) AS ids, list(src ORDER BY seq) AS srcs
  FROM txn WHERE debit > 0 GROUP BY d, vk HAVING count(*) >= 2 AND sum(debit) > 10000
)"""
SPLIT = draft(
    4, "P2", "MEDIUM", "sp", {"k_date": "d", "k_vendor": "vk"},
    vendor="vk", amount="total", amount_type="'Total Paid (Multiple Transactions)'", date_1="d", bank="bank",
    operation_type="op",
    source_loc="array_to_string(srcs[1:3], '; ') || CASE WHEN n > 3 THEN ' (+' || CAST(n - 3 AS VARCHAR) "
               "|| ' more)' ELSE '' END",
    evidence=f"CAST(n AS VARCHAR) || ' payments totaling ' || {money('total')} || ' on same day' || "
             "CASE WHEN largest > 5000 THEN ' (at least one >$5k)' ELSE '' END || ', may indicate approval limits'",
    txn_ids=joined("ids"), links=labelled("ids"),
    next_step="'Verify business justification and approval chain'", risk="'Potential approval splitting pattern'",
    action="'Review reason for multiple payments to same vendor'")


def weekend_ctes(floor: str = "25000") -> str:
    return f"""
pv AS (SELECT debit, row_number() OVER (ORDER BY debit) - 1 AS i, count(*) OVER () AS n FROM txn WHERE debit > 0),
pp AS (
  SELECT max(n) AS n,
         max(CASE WHEN i = (n - 1) * 95 // 100 THEN debit END) AS lo,
         max(CASE WHEN i = ((n - 1) * 95 + 99) // 100 THEN debit END) AS hi,
         max((n - 1) * 95 % 100) AS part
  FROM pv
),
rs AS (
  SELECT COALESCE(n, 0) AS n,
         CASE WHEN n > 20 THEN CAST(lo + (hi - lo) * CAST(part AS DECIMAL(5,0)) / 100 AS DECIMAL(24,6)) END AS p95,
         greatest(CAST({floor} AS DECIMAL(24,6)),
           CASE WHEN n > 20 THEN CAST(lo + (hi - lo) * CAST(part AS DECIMAL(5,0)) / 100 AS DECIMAL(24,6)) END) AS thr
  FROM pp
),
wh AS (
  SELECT *, CASE WHEN isodow(d) = 6 THEN 'Sat' ELSE 'Sun' END AS dn,
         row_number() OVER (ORDER BY seq) AS rn, row_number() OVER (ORDER BY debit DESC, seq) AS tn,
         count(*) OVER () AS hits
  FROM txn WHERE debit > (SELECT thr FROM rs) AND isodow(d) >= 6
    AND NOT {has('description_clean', C.WEEKEND_EXCLUDED_WORDS)}
),
wc AS (
  SELECT count(*) AS n, sum(debit) AS total, min(d) AS d1, max(d) AS d2,
         CASE WHEN count(DISTINCT bank) > 1 THEN 'Multiple' ELSE min(bank) END AS bank,
         list(txn_id ORDER BY rn) FILTER (rn <= 15) AS ids,
         string_agg(substring(vk, 1, 25) || ' (' || {money('debit', 0)} || ', ' || dn || ')', '; ' ORDER BY tn)
           FILTER (tn <= 3) AS top
  FROM wh HAVING count(*) > 3
)"""


WEEKEND_SINGLE = draft(
    5, "P3", "LOW", "wh WHERE hits <= 3", {"k_seq": "seq"},
    vendor="vk", amount="debit", amount_type="'Transaction Amount'", date_1="d", bank="bank", operation_type="op",
    source_loc="src", evidence="'Posted on ' || dn || ' (posting date may differ from transaction date)'",
    txn_ids="txn_id", links="'Related:' || txn_id",
    next_step="'Verify business justification if material'", risk="'Weekend posting (review context)'",
    action="'Note: Posting date may differ from processing date'")
WEEKEND_MANY = draft(
    6, "P3", "LOW", "wc", {},
    vendor="CAST(n AS VARCHAR) || ' transactions; see details'", amount="total",
    amount_type="'Total Amount (Multiple Transactions)'", date_1="d1", date_2="d2", bank="bank",
    operation_type="'Multiple'", source_loc="'Multiple (' || CAST(n AS VARCHAR) || ' txns)'",
    evidence=f"CAST(n AS VARCHAR) || ' weekend postings >' || {money('(SELECT thr FROM rs)', 0)} || ', totaling ' || "
             f"{money('total')} || '. Top 3: ' || top",
    txn_ids=joined("ids") + " || CASE WHEN n > 15 THEN '...' ELSE '' END", links=labelled("ids"),
    next_step="'Review for business context; posting dates may differ from processing dates'",
    risk="'Weekend posting pattern (review context)'",
    action="'Note: Weekend postings common for automated systems and deadline-driven payments'")

VELOCITY_CTES = """
hv AS (SELECT d, count(*) AS n, sum(debit) AS total, list(txn_id ORDER BY seq)[1:10] AS ids
       FROM txn WHERE debit > 20000 GROUP BY d HAVING count(*) >= 5)"""
VELOCITY = draft(
    7, "P3", "LOW", "hv", {"k_date": "d"},
    vendor="CAST(n AS VARCHAR) || ' vendors'", amount="total", amount_type="'Total Amount (Single Day)'",
    date_1="d", bank="'Multiple'", operation_type="'Multiple'", source_loc="'See Txn_IDs'",
    evidence="CAST(n AS VARCHAR) || ' large payments (>$20,000) on single day'",
    txn_ids=joined("ids"), links=labelled("ids"),
    next_step="'Review for business context (e.g., month-end, quarter-end)'",
    risk="'Unusual concentration of payments'",
    action="'Review for business justification (e.g., period-end processing)'")

GROWTH_CTES = f"""
gr AS (SELECT *, strftime(d, '%Y-%m') AS m FROM txn
       WHERE debit > 0 AND op NOT IN {listed(C.GROWTH_EXCLUDED_CATEGORIES)}),
gm AS (SELECT vk, m, sum(debit) AS spend, count(*) AS n, max(d) AS last_day,
              list(txn_id ORDER BY debit DESC, seq)[1:2] AS ids FROM gr GROUP BY vk, m),
gb AS (SELECT * FROM gm QUALIFY row_number() OVER (PARTITION BY vk ORDER BY m) = 1),
gl AS (SELECT * FROM gm WHERE m = (SELECT max(m) FROM gr)),
gw AS (
  SELECT b.vk, b.m AS bm, b.spend AS bs, l.m AS lm, l.spend AS ls, l.last_day AS anchor, b.ids AS bi, l.ids AS li,
         {joined('b.ids')} || CASE WHEN b.n > 2 THEN ' (+' || CAST(b.n - 2 AS VARCHAR) || ' more)' ELSE '' END AS bt,
         {joined('l.ids')} || CASE WHEN l.n > 2 THEN ' (+' || CAST(l.n - 2 AS VARCHAR) || ' more)' ELSE '' END AS lt
  FROM gb b JOIN gl l ON b.vk = l.vk
  WHERE b.spend > 1000 AND l.spend > 2 * b.spend AND (SELECT count(DISTINCT d) FROM txn) > 30
    AND (SELECT count(DISTINCT m) FROM gr) >= 2
)"""
GROWTH = draft(
    8, "P3", "LOW", "gw", {"k_vendor": "vk"},
    vendor="vk", amount="ls - bs", amount_type="'Baseline-to-Latest Growth (Delta)'",
    date_1="CAST(bm || '-01' AS DATE)", date_2="CAST(lm || '-01' AS DATE)", anchor_date="anchor",
    bank="'Multiple'", operation_type="'Multiple (Aggregate)'",
    source_loc="'Monthly vendor totals: ' || bm || '→' || lm",
    evidence=f"bm || ': ' || {money('bs')} || ' → ' || lm || ': ' || {money('ls')} || "
             "' (baseline = first active month in period)'",
    txn_ids="'Baseline ' || bm || ': ' || bt || ' | Latest ' || lm || ': ' || lt",
    links=labelled("bi", "Baseline") + " || ', ' || " + labelled("li", "Latest"),
    next_step="'Review contract terms, pricing changes, volume justification'",
    risk="'Dependency increasing over time'", action="'Review contract terms and pricing changes'")


def shown(source: str) -> str:
    """Presentation of drafts or findings: money as DOUBLE, dates as text."""
    cols = []
    for f in FIELDS:
        if f == "amount":
            cols.append("CAST(amount AS DOUBLE) AS amount")
        elif f in ("date_1", "date_2", "anchor_date"):
            cols.append(f"{text(f)} AS {f}")
        else:
            cols.append(f)
    return ", ".join(cols), source


def rule_query(ctes: str, select: str, calendar: str = "actual") -> str:
    cols, _ = shown("x")
    return with_txn(f"SELECT {cols} FROM ({select}) x", calendar, ctes)


def finding_ctes(floor: str = "25000") -> str:
    """CTE ``fnd``: all rules, numbered."""
    rules = [DUPLICATE, COUNTERPARTY, ROUND, SPLIT, WEEKEND_SINGLE, WEEKEND_MANY, VELOCITY, GROWTH]
    ctes = [DUPLICATE_CTES, COUNTERPARTY_CTES, ROUND_CTES, SPLIT_CTES, weekend_ctes(floor), VELOCITY_CTES, GROWTH_CTES]
    union = "\nUNION ALL\n".join(rules)
    return ",".join(ctes) + f""",
dr AS MATERIALIZED ({union}),
fnd AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY rule_no, k_date NULLS FIRST, k_vendor NULLS FIRST, k_amount NULLS FIRST,
            k_day NULLS FIRST, k_seq NULLS FIRST) AS alert_seq,
         printf('A%04d', row_number() OVER (ORDER BY rule_no, k_date NULLS FIRST, k_vendor NULLS FIRST,
            k_amount NULLS FIRST, k_day NULLS FIRST, k_seq NULLS FIRST)) AS alert_id
  FROM dr
)"""


def findings_query(body: str, calendar: str = "actual", extra: str = "") -> str:
    more = finding_ctes() + (f",\n{extra}" if extra else "")
    return with_txn(body, calendar, more)
