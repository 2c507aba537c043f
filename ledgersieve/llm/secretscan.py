"""Secrets in texts: keywords first, expressions only where one stands, checksums last.

One Aho-Corasick automaton over the bytes of a text, A-Z lower-cased, finds every
keyword in one pass.  An expression is tried only at the place of its keyword, anchored
there, so a text without keywords meets no expression.  Runs of hexadecimal digits have
no keyword; a table of byte classes finds the long ones on the whole slice of texts.

Base kinds (``assign``, ``access``, ``hex``) always stay.  The other kinds carry a check
of their own inside, and count only if it holds:

``github``, ``npm``  the last 6 of 36 signs are the CRC-32 of the first 30, in base 62
``jwt``              header and claims are JSON objects, and the header names an algorithm
``pem``              a private key whose DER sequence is as long as its header says
``xprv``             an extended private key, with four bytes of its double SHA-256

A text is scanned whole, by the task that reads it; nothing is shuffled, so a lost
executor costs the scan of its splits.  Memory follows the slice, or the longest text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgersieve.llm import words as W

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "pem", "xprv")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# Keywords in lower case, and the expression that is anchored at each.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_GITHUB = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_JWT = re.compile(rb"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++")
_PEM = re.compile(rb"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----\s*+([A-Za-z0-9+/=\s]++)-----END \1-----")
_XPRV = re.compile(rb"xprv([1-9A-HJ-NP-Za-km-z]{107})(?![1-9A-HJ-NP-Za-km-z])")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ANCHORED = {
    "assign": (_ASSIGN, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    "access": (_ACCESS, ("akia",)),
    "github": (_GITHUB, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    "npm": (_NPM, ("npm_",)), "jwt": (_JWT, ("eyj",)), "pem": (_PEM, ("-----begin ",)), "xprv": (_XPRV, ("xprv",)),
}
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_HEX = np.zeros(256, bool)
_HEX[48:58] = _HEX[97:103] = True


def number(digits: bytes, alphabet: bytes) -> int:
    value = 0
    for sign in digits:
        value = value * len(alphabet) + alphabet.index(sign)
    return value


def _crc(found: re.Match) -> bool:
    """Base 62 of the CRC-32, padded by zeros."""
    return number(found[2], _BASE62) == zlib.crc32(found[1])


def _json(part: bytes) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, RecursionError):  # not base 64, not UTF-8, not JSON
        return None
    return value if isinstance(value, dict) else None


def _jwt(found: re.Match) -> bool:
    header = _json(found[1])
    return header is not None and isinstance(header.get("alg"), str) and _json(found[2]) is not None


def _der(found: re.Match) -> bool:
    """Whether the first element is a sequence that ends where the data ends."""
    try:
        data = base64.b64decode(b"".join(found[2].split()), validate=True)
    except binascii.Error:
        return False
    if len(data) < 2 or data[0] != 0x30:
        return False
    if data[1] < 0x80:
        return len(data) == 2 + data[1]
    n = data[1] & 0x7F
    return 0 < n <= 8 and len(data) == 2 + n + int.from_bytes(data[2 : 2 + n], "big")


def _xprv(found: re.Match) -> bool:
    value = number(found[0], _BASE58)
    if value.bit_length() > 82 * 8:
        return False
    data = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


CHECKS = {
    "assign": lambda m: len(m[2]) >= LEAST_VALUE, "access": lambda m: len(m[0]) >= LEAST_ACCESS,
    "github": _crc, "npm": _crc, "jwt": _jwt, "pem": _der, "xprv": _xprv,
}


def automaton() -> ahocorasick.Automaton:
    """Keywords to (kind, length); a byte is the character of its number."""
    found = ahocorasick.Automaton()
    for kind, (_, keywords) in ANCHORED.items():
        for word in keywords:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def keyed_spans(data: bytes, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes of all checked matches, leftmost first and disjoint within a kind.

    A match begins with a keyword, and keywords are met by their end; only ``assign`` has
    some of different length, none of which ends inside a longer one that begins later.
    """
    out, reach = [], dict.fromkeys(ANCHORED, 0)
    for last, (kind, size) in keywords.iter(data.lower().decode("latin-1")):
        start = last + 1 - size
        if start < reach[kind]:
            continue
        match = ANCHORED[kind][0].match(data, start)
        if match is not None:
            reach[kind] = match.end()
            if CHECKS[kind](match):
                out.append((kind, start, match.end()))
    return out


def hex_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) in bytes of the slice: whole runs of hexadecimal digits that are long enough."""
    inside = _HEX[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    long = np.flatnonzero((np.diff(at) >= LEAST_HEX) & inside[at[:-1]])
    start, end = at[long], at[long + 1]
    return np.searchsorted(offsets, start, "right") - 1, start, end


def scan(texts: pa.Array) -> list[list[dict]]:
    """The spans of each text, in code points, by start, then kind."""
    keywords, out = automaton(), []
    raw, offsets = W.text_bytes(texts)
    for i, j in W.slices(offsets):
        base, part = offsets[i], raw[offsets[i] : offsets[j]]
        spans: list[list] = [[] for _ in range(i, j)]
        if len(part):
            for text, start, end in zip(*(x.tolist() for x in hex_runs(part, offsets[i : j + 1] - base))):
                begin = int(offsets[i + text] - base)
                spans[text].append(("hex", start - begin, end - begin))
        for t in range(i, j):
            data = raw[offsets[t] : offsets[t + 1]]
            found = spans[t - i] + keyed_spans(data.tobytes(), keywords)
            if found and data.max() > 127:
                # Code points before a byte are the bytes before it that begin one.
                points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                found = [(kind, int(points[a]), int(points[b])) for kind, a, b in found]
            found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
            out.append([{"kind": kind, "start": a, "end": b} for kind, a, b in found])
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns and ``secret_spans``: array of (kind, start, end).

    Places are code points, end exclusive; the array is ordered by start, then by
    ``KINDS``; spans of one kind are disjoint, those of two kinds may overlap.  Null and
    empty texts have an empty array; repeated rows have a row each; null and repeated ids
    do not matter, as no row meets another.  A column of that name is replaced.
    """
    rows = docs.drop("secret_spans")
    place = rows.columns.index("text")
    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes), "secret_spans array<struct<kind:string,start:bigint,end:bigint>>"])

    def run(batches):
        for batch in batches:
            found = pa.array(scan(batch.column(place)), pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "secret_spans"])

    return rows.mapInArrow(run, schema)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of a secret replaced by its kind in brackets; spans that overlap become one, named by the first."""
    def cut(x, y):
        return F.when((F.size(x) > 0) & (F.element_at(x, -1)["end"] > y["start"]), F.concat(
            F.slice(x, F.lit(1), F.size(x) - 1), F.array(F.struct(
                F.element_at(x, -1)["kind"].alias("kind"), F.element_at(x, -1)["start"].alias("start"),
                F.greatest(F.element_at(x, -1)["end"], y["end"]).alias("end"))))).otherwise(F.concat(x, F.array(y)))

    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    rows = secrets(docs).withColumn("secret_spans", F.aggregate("secret_spans", empty, cut))
    cuts, text = F.col("secret_spans"), F.col("text")
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    begin = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(cuts, F.greatest(i, F.lit(1)))["end"])
    pieces = F.transform(cuts, lambda c, i: F.concat(part(begin(i), c["start"]), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    tail = part(F.element_at(cuts, -1)["end"], F.length(text).cast("long"))
    new = F.when(F.size(cuts) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return rows.withColumn("text", new).select(*(F.col(f"`{c}`") for c in docs.columns if c != "secret_spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex (base spans), base_sha256, spans, n_added.

    Digest and ``spans`` are of kind:start:end, comma-joined; the digest is of base spans
    alone.  ``n_added`` counts the spans whose embedded check holds.
    """
    rows = secrets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    found = F.col("secret_spans")
    of = lambda kind: F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(found, lambda x: x["kind"].isin(*BASE))
    return rows.select("doc_id", *(of(k).alias(f"n_{k}") for k in BASE), F.sha2(_listed(base), 256).alias("base_sha256"),
                       _listed(found).alias("spans"), (F.size(found) - F.size(base)).cast("long").alias("n_added"))
