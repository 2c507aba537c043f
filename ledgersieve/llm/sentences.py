"""Repeated runs of consecutive sentences.

A sentence ends at a full stop, question or exclamation mark before white space, or at a
line's end.  Sentences are cut further at minimisers: before the word of smallest hash in
every window of ``WINDOW`` words that lies in one sentence.  A run is the
fewest consecutive pieces, ``RUN`` at least, that have ``LEAST_WORDS`` words together.
Every run is hashed by its words; runs are joined over all documents, and the pieces
of every run that is not the first of its kind are removed.

A cut ``WINDOW - 1`` words or more inside a copied passage depends on the passage alone,
and any ``WINDOW`` words hold a cut.  So any 6 * ``WINDOW`` - 2 = 46 words (with their
sentence ends) hold 4 cuts that all copies share, hence a whole run, and no longer passage is missed.  Within
whole sentences all cuts depend on them alone, so a run of whole sentences is found too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.spans import bit_table, in_table, merged
from ledgersieve.llm.store import written

RUN, WINDOW = 3, 8
#: Fewer words say too little: short sentences repeat by chance.
LEAST_WORDS = 15
PLACE_BITS = 24
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".!?"]] = True


def sentence_starts(words: W.Words) -> np.ndarray:
    """Places of the words that begin a sentence, or a piece of one."""
    n = len(words.hash)
    if not n:
        return np.empty(0, np.int64)
    text = words.text
    space = ~W.GRAPHIC[text]
    ends = text == 10
    ends[:-1] |= _MARK[text[:-1]] & space[1:]
    sums = np.r_[0, np.cumsum(ends)]
    begin = np.ones(n, bool)
    begin[1:] = sums[words.start[1:]] > sums[words.end[:-1]]
    begin[words.first[:-1][np.diff(words.first) > 0]] = True
    bits = max(PLACE_BITS, int(n).bit_length())
    low = np.uint64((1 << bits) - 1)
    key = (W.mix(words.hash) & ~low) | np.arange(n, dtype=np.uint64)
    for step in (1, 2, 4):
        key = np.minimum(key[:-step], key[step:]) if len(key) > step else key[:0]
    if len(key):
        sentence = np.cumsum(begin)
        whole = sentence[: len(key)] == sentence[WINDOW - 1 :]
        begin[(key[whole] & low).astype(np.int64)] = True
    return np.flatnonzero(begin)


def runs(words: W.Words):
    """(first word, end word, text, hash) of every run.

    A text of fewer than ``RUN`` sentences is one run, if it has the words.
    """
    start = sentence_starts(words)
    if not len(start):
        return (np.empty(0, np.int64),) * 4
    end = np.r_[start[1:], len(words.hash)]
    first = np.searchsorted(start, words.first)       # sentences of each text
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(start))
    last = np.maximum(at + np.minimum(RUN, np.diff(first)[text]) - 1, np.searchsorted(end, start + LEAST_WORDS))
    whole = last < first[text + 1]
    low, high, text = start[whole], end[last[whole]], text[whole]
    return low, high, text, W.span_hash(words.hash, low, high).view(np.int64)


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, first_doc, first_start): runs, in words, whose like comes earlier.

    Earlier is by doc_id, then by place.  Null and empty texts have no sentence, rows
    with a null doc_id are left aside, rows that repeat a doc_id and a text are one
    document; other columns are left aside.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")

    def listed(table):
        def run(batches):
            for batch in batches:
                for i, j, words in W.each_slice(batch.column(1)):
                    low, high, text, h = runs(words)
                    if table is not None:
                        hit = in_table(table.value, h)
                        low, high, text, h = low[hit], high[hit], text[hit], h[hit]
                    ids, base = batch.column(0).to_numpy()[i:j], words.first[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(ids[text]), pa.array((low - base).astype(np.int32)), pa.array((high - base).astype(np.int32))],
                        names=["h", "doc_id", "start", "end"])

        return texts.mapInArrow(run, "h long, doc_id long, start int, end int")

    groups = listed(None).groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start")).alias("first"))
    groups = written(groups.where("n > 1").select("h", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start")), "groups")
    table = docs.sparkSession.sparkContext.broadcast(bit_table(groups, "h"))
    again = (F.col("doc_id") != F.col("first_doc")) | (F.col("start") != F.col("first_start"))
    return listed(table).join(groups, "h").where(again).select("doc_id", "start", "end", "first_doc", "first_start")


def repeated_sentences(docs: DataFrame) -> DataFrame:
    """One row per document with repeated runs: doc_id, n_repeated, spans, first_docs (see ``merged``)."""
    return merged(written(repeats(docs), "repeats"))
