"""The screening rules over a list of rows in id order, as plain loops for small data."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

from ledgersieve import config as C


def key(r):
    return (r["vendor_normalized"] or "").strip() or "UNKNOWN"


def paid(rows):
    return [r for r in rows if r["debit"] is not None and r["debit"] > 0]


def says(text, words):
    return any(w in (text or "").lower() for w in words)


def duplicates(rows):
    kept = [r for r in paid(rows) if r["operation_type"] not in C.RECURRING_CATEGORIES]
    kept.sort(key=lambda r: (key(r), r["debit"], r["date"], r["txn_seq"]))
    out = []
    for a, b in zip(kept, kept[1:]):
        days = abs((a["date"] - b["date"]).days)
        if (key(a) == key(b) and a["debit"] >= 100 and (b["debit"] - a["debit"]) / a["debit"] < Decimal("0.01")
                and 1 <= days <= 3 and not says(a["description_clean"], C.DUPLICATE_FEE_PHRASES)):
            out.append(f"{a['txn_id']}, {b['txn_id']}")
    return out


def counterparties(rows):
    first, out = {}, {}
    for r in paid(rows):
        first[key(r)] = min(first.get(key(r), r["date"]), r["date"])
    for r in paid(rows):
        v = key(r)
        if r["date"] == first[v] and r["debit"] > 50000 and v not in out and not says(v, C.COUNTERPARTY_EXCLUDED_WORDS):
            out[v] = r["txn_id"]
    return [out[v] for v in sorted(out)]


def rounds(rows):
    hits = [r for r in paid(rows) if r["debit"] >= 1000 and r["debit"] % 1000 == 0
            and not says(r["description_clean"], C.FIXED_COST_WORDS)]
    groups = defaultdict(list)
    for r in hits:
        groups[r["debit"]].append(r)
    out = []
    for amount in sorted(groups):
        g = groups[amount]
        if len(hits) >= 3 and len(g) >= 2:
            vendors = list(dict.fromkeys(key(r) for r in g))[:2]
            out.append((f"{len(g)} transactions: {', '.join(vendors)}...", ", ".join(r["txn_id"] for r in g[:5])))
    return out


def splits(rows):
    groups = defaultdict(list)
    for r in paid(rows):
        groups[(r["date"], key(r))].append(r)
    return [(k, sum(r["debit"] for r in g), ", ".join(r["txn_id"] for r in g))
            for k, g in sorted(groups.items()) if len(g) >= 2 and sum(r["debit"] for r in g) > 10000]


def velocity(rows):
    groups = defaultdict(list)
    for r in paid(rows):
        if r["debit"] > 20000:
            groups[r["date"]].append(r)
    return [(d, len(g), ", ".join(r["txn_id"] for r in g[:10])) for d, g in sorted(groups.items()) if len(g) >= 5]


def growth(rows):
    if len({r["date"] for r in rows}) <= 30:
        return []
    kept = [r for r in paid(rows) if r["operation_type"] not in C.GROWTH_EXCLUDED_CATEGORIES]
    months = sorted({r["date"].strftime("%Y-%m") for r in kept})
    spend = defaultdict(lambda: defaultdict(list))
    for r in kept:
        spend[key(r)][r["date"].strftime("%Y-%m")].append(r)
    out = []
    for v in sorted(spend):
        base = min(spend[v])
        total = lambda m: sum((r["debit"] for r in spend[v].get(m, [])), Decimal(0))
        if len(months) >= 2 and total(base) > 1000 and total(months[-1]) > 2 * total(base):
            texts = []
            for name, m in (("Baseline", base), ("Latest", months[-1])):
                g = sorted(spend[v][m], key=lambda r: (-r["debit"], r["txn_seq"]))
                ids = ", ".join(r["txn_id"] for r in g[:2]) + (f" (+{len(g) - 2} more)" if len(g) > 2 else "")
                texts.append(f"{name} {m}: {ids}")
            out.append((v, total(months[-1]) - total(base), " | ".join(texts)))
    return out
