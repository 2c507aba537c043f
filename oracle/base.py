"""Common table expressions: the statement view and the canonical transactions in SQL."""

from __future__ import annotations

from ledgersieve import config as C
from ledgersieve.sources import fixtures as X

SPACE = " \t\n\r\x0b\x0c"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def pick(values, key: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


def has(column: str, words) -> str:
    return f"COALESCE(regexp_matches(lower({column}), {quoted('|'.join(words))}), false)"


def strip(x: str) -> str:
    return f"trim({x}, {quoted(SPACE)})"


def replaced(x: str, patterns, flags: str = "gi", by: str = "") -> str:
    for p in patterns:
        x = f"regexp_replace({x}, {quoted(p)}, {quoted(by)}, {quoted(flags)})"
    return x


def clean_description(x: str) -> str:
    inner = replaced(strip(x), [*C.DESCRIPTION_PREFIXES, C.DESCRIPTION_REFERENCE])
    inner = strip(replaced(inner, [r"\s+"], "g", " "))
    return f"CASE WHEN {strip(x)} = '' THEN {x} ELSE COALESCE(NULLIF({inner}, ''), {strip(x)}) END"


def normalize_vendor(x: str) -> str:
    inner = replaced(f"upper({strip(x)})", [*C.VENDOR_PREFIXES, C.VENDOR_REFERENCE])
    inner = replaced(inner, [C.VENDOR_COMPANY_WORDS, r"[.,;:\-]"], "g")
    inner = strip(replaced(inner, [r"\s+"], "g", " "))
    return f"CASE WHEN {strip(x)} = '' THEN {x} ELSE {inner} END"


def keyword_category(x: str) -> str:
    arms = " ".join(
        f"WHEN regexp_matches(lower({x}), {quoted(C.phrase_pattern(p))}) THEN {quoted(n)}"
        for n, p in C.CATEGORY_PHRASES)
    return f"CASE WHEN {x} IS NULL THEN 'Other' {arms} ELSE 'Other' END"


FIX_STEPS = (
    # (previous category, extra condition, words, new category), applied one after the other
    ("Customer Payments", "true", C.FIX_TAX_WORDS, "Taxes & Government"),
    ("Customer Payments", "true", C.FIX_OUTWARD_WORDS, "Vendor Payments"),
    ("Customer Payments", "debit > 0", C.FIX_RETAIL_WORDS, "Vendor Payments"),
    ("Inventory & Suppliers", "credit > 0", C.FIX_CUSTOMER_WORDS[:4], "Customer Payments"),
    ("Inventory & Suppliers", "credit > 0", ("wholesale",), "Customer Payments"),
    ("Card Processing", "credit > 0", C.FIX_SETTLEMENT_WORDS, "Card Settlement (Income)"),
    ("Card Processing", "debit > 0", C.FIX_FEE_WORDS, "Card Fees"),
)


def fix_ctes(source: str) -> str:
    """One CTE per correction, so their order is explicit."""
    out, prev = [], source
    for i, (old, cond, words, new) in enumerate(FIX_STEPS):
        out.append(
            f"fix{i} AS (SELECT * REPLACE (CASE WHEN op = {quoted(old)} AND ({cond}) AND "
            f"{has('description_clean', words)} THEN {quoted(new)} ELSE op END AS op) FROM {prev})")
        prev = f"fix{i}"
    return ",\n".join(out), prev


def movements(calendar: str = "actual") -> str:
    paid, received = "CAST(l_shipdate AS DATE)", "CAST(o_orderdate AS DATE)"
    if calendar == "folded":
        def fold(d: str, grows: str) -> str:
            day = f"(date_diff('day', DATE '1995-01-01', {d}) % {X.FOLD_DAYS})"
            late = f"CAST(floor(sqrt(CAST({day} * {X.FOLD_DAYS} AS DOUBLE))) AS INTEGER)"
            return (f"CAST(DATE '{X.FOLD_START}' + CAST(CASE WHEN {grows} THEN {late} ELSE {day} END AS INTEGER)"
                    " AS DATE)")
        paid, received = fold(paid, "l_suppkey % 4 = 0"), fold(received, "false")
    return f"""
moves AS (
  SELECT {paid} AS d, 0 AS kind, l_orderkey AS k1, CAST(l_linenumber AS BIGINT) AS k2, l_partkey AS k3,
         {pick(X.PAYMENT_RAILS, 'l_linenumber')} || {pick(X.PURPOSES, 'l_suppkey')} || ' '
           || replace(s_name, 'Supplier#', 'Trader ') || ', Inc INV ' || CAST(l_orderkey AS VARCHAR) AS description,
         CAST(CASE WHEN l_partkey % 40 = 0 THEN greatest(1000.0, floor(l_extendedprice / 1000) * 1000)
              ELSE l_extendedprice END AS DECIMAL(18,2)) AS debit,
         CAST(NULL AS DECIMAL(18,2)) AS credit, {pick(X.BANKS, 'l_suppkey')} AS bank
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  UNION ALL
  SELECT {received}, 1, o_orderkey, 0, o_custkey,
         {pick(X.RECEIPT_RAILS, 'o_orderkey')} || replace(c_name, 'Customer#', 'Buyer '),
         CAST(NULL AS DECIMAL(18,2)), CAST(o_totalprice AS DECIMAL(18,2)), {pick(X.BANKS, 'o_custkey')}
  FROM orders JOIN customer ON o_custkey = c_custkey
),
stmt AS (
  SELECT d, description, debit, credit, bank, bank || '_statement.csv' AS source_file, 'Sheet1' AS source_sheet,
         1 + row_number() OVER (PARTITION BY bank ORDER BY d, kind, k1, k2, k3,
           debit NULLS FIRST, credit NULLS FIRST, description) AS source_row
  FROM moves
)"""


def canonical_ctes(source: str = "stmt") -> str:
    fixes, last = fix_ctes("kw")
    return f"""
cleaned AS MATERIALIZED (SELECT *, {clean_description('description')} AS description_clean FROM {source}),
kw AS (SELECT *, {keyword_category('description')} AS op FROM cleaned),
{fixes},
txn AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY d, source_file, source_sheet, source_row) AS seq,
         printf('TXN_%05d', row_number() OVER (ORDER BY d, source_file, source_sheet, source_row)) AS txn_id,
         d, description, description_clean, {normalize_vendor('description_clean')} AS vendor_normalized,
         COALESCE(NULLIF({strip(normalize_vendor('description_clean'))}, ''), 'UNKNOWN') AS vk,
         debit, credit, COALESCE(credit, 0) - COALESCE(debit, 0) AS amount_signed, op,
         CASE WHEN credit > 0 THEN 'Inflow' WHEN debit > 0 THEN 'Outflow' ELSE 'Unknown' END AS direction,
         bank, source_file, source_sheet, source_row,
         source_file || ' | ' || source_sheet || ' | R' || CAST(source_row AS VARCHAR) AS src
  FROM {last}
)"""


def with_txn(body: str, calendar: str = "actual", extra: str = "") -> str:
    """Full statement: the transactions CTEs, optional further CTEs, then ``body``."""
    more = f",\n{extra}" if extra else ""
    return f"WITH {movements(calendar)},\n{canonical_ctes()}{more}\n{body}"


def money(x: str, decimals: int = 2) -> str:
    return f"('$' || format('{{:,.{decimals}f}}', CAST({x} AS DOUBLE)))"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"
