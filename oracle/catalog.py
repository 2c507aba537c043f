"""SQL per registered query name."""

from __future__ import annotations

from oracle import reports, rules as Q
from oracle.base import text, with_txn


def oracle_sql() -> dict[str, str]:
    out = {
        "duplicate_payments": Q.rule_query(Q.DUPLICATE_CTES, Q.DUPLICATE),
        "new_counterparties": Q.rule_query(Q.COUNTERPARTY_CTES, Q.COUNTERPARTY),
        "round_amounts": Q.rule_query(Q.ROUND_CTES, Q.ROUND),
        "split_payments": Q.rule_query(Q.SPLIT_CTES, Q.SPLIT),
        "weekend_single": Q.rule_query(Q.weekend_ctes(), Q.WEEKEND_SINGLE),
        "weekend_collapsed": Q.rule_query(Q.weekend_ctes(), Q.WEEKEND_MANY),
        "high_velocity": Q.rule_query(Q.VELOCITY_CTES, Q.VELOCITY),
        "vendor_growth": Q.rule_query(Q.GROWTH_CTES, Q.GROWTH, "folded"),
        "run_statistics": with_txn(
            "SELECT CAST(n AS BIGINT) AS weekend_outflow_txn_count, CAST(p95 AS DOUBLE) AS p95_debit, "
            "CAST(thr AS DOUBLE) AS weekend_threshold, CAST(25000 AS DOUBLE) AS weekend_threshold_floor FROM rs",
            extra=Q.weekend_ctes()),
        "transactions": with_txn(
            f"SELECT txn_id, seq AS txn_seq, {text('d')} AS date, description, description_clean, vendor_normalized, "
            "CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit, "
            "CAST(amount_signed AS DOUBLE) AS amount_signed, op AS operation_type, direction, bank, source_file, "
            "source_sheet, source_row FROM txn"),
    }
    cols, _ = Q.shown("fnd")
    for name, calendar in (("findings", "actual"), ("findings_folded", "folded")):
        out[name] = Q.findings_query(f"SELECT alert_seq, alert_id, {cols} FROM fnd", calendar)
    return {**out, **reports.queries()}
