"""Repeated passages by a sparse suffix array.

A suffix is retained where a minimiser stands: in every window of ``WINDOW`` consecutive
8-grams the one of smallest hash.  The choice depends on the words alone, so two copies of
a passage retain the same suffixes, about two in ``WINDOW + 1``.  Suffixes that begin with
the same ``PREFIX`` words are sorted by what follows, and again by what stands before;
each is compared with its neighbours in both orders and with the first of all, and a match
is extended to the left and right.

A passage of ``PREFIX + WINDOW - 1`` = 50 words or more that occurs elsewhere always
retains a suffix with its first 35 words in the passage, so none is missed.  A reported
span is at least 35 words long; up to 15 words at a passage's ends may be left out if the
copy that shares them is no neighbour.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.spans import bit_table, in_table, merged
from ledgersieve.llm.store import parts, written

GRAM, WINDOW, PREFIX = 8, 16, 35
#: Words of context on either side.  A longer match holds another retained suffix.
CONTEXT = 16
#: Suffixes with one prefix that are sorted together; larger groups are dealt to several.
GROUP_ROWS = 20_000
PLACE_BITS = 24


def retained(words: W.Words) -> np.ndarray:
    """Places, within a slice, of the words at which a suffix of ``PREFIX`` words is retained."""
    grams, at = W.grams(words.hash, words.first, GRAM)
    bits = max(PLACE_BITS, int(len(words.hash)).bit_length())
    low = np.uint64((1 << bits) - 1)
    key = (grams & ~low) | at.astype(np.uint64)
    for step in (1, 2, 4, 8):
        key = np.minimum(key[:-step], key[step:]) if len(key) > step else key[:0]
    if not len(key):
        return np.empty(0, np.int64)
    whole = at[WINDOW - 1 :] - at[: len(key)] == WINDOW - 1  # grams of one text only
    end = np.repeat(words.first[1:], np.diff(words.first))
    found = np.unique((key[whole] & low).astype(np.int64))
    return found[found + PREFIX <= end[found]]


def _rows(words: W.Words):
    place = retained(words)
    text = np.searchsorted(words.first, place, "right") - 1
    return place, text, W.span_hash(words.hash, place, place + PREFIX).view(np.int64)


def _around(words: W.Words, place: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words before each suffix, nearest first, and of those after its prefix; 0 outside."""
    short = (words.hash >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    steps = np.arange(CONTEXT)
    left, right = place[:, None] - 1 - steps, place[:, None] + PREFIX + steps
    low, high = words.first[text][:, None], words.first[text + 1][:, None]
    take = lambda x, ok: np.where(ok, short[np.clip(x, 0, max(len(short) - 1, 0))], np.uint32(0)) if len(short) else np.zeros(x.shape, np.uint32)
    return take(left, left >= low), take(right, right < high)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    same = (a == b) & (a != 0)
    return CONTEXT if same.all() else int(same.argmin())


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, first_doc, first_start): repeated spans, in words, that are not the first.

    Of all suffixes with one prefix the first, by doc_id and place, stays; every other is
    a repeat.  Its span is extended by what it has in common with an earlier one among
    its neighbours and the first, so the words of a span are always found earlier.  Texts
    are compared in lower case by their words alone.

    Null and empty texts have no suffix, rows with a null doc_id are left aside, rows
    that repeat a doc_id and a text are one document; other columns are left aside.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")

    def keys(batches):
        for batch in batches:
            for i, j, words in W.each_slice(batch.column(1)):
                place, text, h = _rows(words)
                ids = batch.column(0).to_numpy()[i:j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(ids[text]), pa.array((place - words.first[text]).astype(np.int32))], names=["h", "doc_id", "at"])

    every = texts.mapInArrow(keys, "h long, doc_id long, at int")
    groups = written(every.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "at")).alias("first")).where("n > 1")
                     .select("h", "n", F.col("first.doc_id").alias("first_doc"), F.col("first.at").alias("first_at")), "groups")
    table = docs.sparkSession.sparkContext.broadcast(bit_table(groups, "h"))

    def contexts(batches):
        for batch in batches:
            for i, j, words in W.each_slice(batch.column(1)):
                place, text, h = _rows(words)
                hit = in_table(table.value, h)
                place, text, h = place[hit], text[hit], h[hit]
                left, right = _around(words, place, text)
                ids = batch.column(0).to_numpy()[i:j]
                pack = lambda x: pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(
                    np.arange(0, x.size * 4 + 1, CONTEXT * 4, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(ids[text]), pa.array((place - words.first[text]).astype(np.int32)), pack(left), pack(right)],
                    names=["h", "doc_id", "at", "left", "right"])

    rows = texts.mapInArrow(contexts, "h long, doc_id long, at int, left binary, right binary").join(groups, "h")
    is_first = (F.col("doc_id") == F.col("first_doc")) & (F.col("at") == F.col("first_at"))
    deals = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
    # The first of a group goes to each of its parts.
    deal = F.when(is_first, F.sequence(F.lit(0), deals - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("doc_id", "at"), deals).cast("int")))
    rows = rows.withColumn("deal", F.explode(deal)).withColumn("is_first", is_first)

    def compare(batches):
        group, first, held = None, None, []
        out = []

        def settle(row, others):
            """The span of ``row``, extended by those of ``others`` that come earlier."""
            h, doc, at, left, right, first_doc, first_at = row
            more_left = more_right = 0
            for other in others:
                if other is not None and (other[1], other[2]) < (doc, at):
                    more_left = max(more_left, _common(left, other[3]))
                    more_right = max(more_right, _common(right, other[4]))
            out.append((doc, at - more_left, at + PREFIX + more_right, first_doc, first_at))

        def ended():
            # ``held`` is in the order of what follows; the other order is by what stands before.
            turned = sorted(range(len(held)), key=lambda n: (held[n][3].tobytes(), held[n][1], held[n][2]))
            place = {n: m for m, n in enumerate(turned)}
            for n, row in enumerate(held):
                if (row[1], row[2]) != (row[5], row[6]):
                    m = place[n]
                    beside = [*held[max(n - 1, 0) : n], *held[n + 1 : n + 2], *(held[x] for x in turned[max(m - 1, 0) : m + 2] if x != n)]
                    settle(row, [*beside, first])

        def batch_of(rows):
            columns = list(zip(*rows)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(columns[i], t) for i, t in enumerate(
                (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()))], names=["doc_id", "start", "end", "first_doc", "first_start"])

        for batch in batches:
            for h, deal, is_first, doc, at, left, right, first_doc, first_at in zip(*(c.to_pylist() for c in batch.columns)):
                row = (h, doc, at, np.frombuffer(left, np.uint32), np.frombuffer(right, np.uint32), first_doc, first_at)
                if (h, deal) != group:
                    ended()
                    group, first, held = (h, deal), None, []
                if is_first:
                    first = row
                if not held or (held[-1][1], held[-1][2]) != (doc, at):
                    held.append(row)
            if len(out) > 10_000:
                yield batch_of(out)
                out.clear()
        ended()
        yield batch_of(out)

    n = parts(docs.sparkSession)
    dealt = rows.select("h", "deal", "is_first", "doc_id", "at", "left", "right", "first_doc", "first_at")
    dealt = dealt.repartition(n, "h", "deal").sortWithinPartitions("h", "deal", "right", "doc_id", "at")
    return dealt.mapInArrow(compare, "doc_id long, start int, end int, first_doc long, first_start int")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per document with repeated passages: doc_id, n_repeated, spans, first_docs (see ``merged``)."""
    return merged(written(repeats(docs), "repeats"))
