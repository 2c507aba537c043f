"""Plain versions of shared rules, for comparison."""

from __future__ import annotations

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}
