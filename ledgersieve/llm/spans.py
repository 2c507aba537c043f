"""Word spans of documents: merging them, and cutting them out of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgersieve.llm import words as W

#: Bits of a fixed-size table of hashes; 16 MB, whatever the input.
TABLE_BITS = 27


def hash_bits(hashes: np.ndarray) -> np.ndarray:
    return (W.mix(hashes.view(np.uint64)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def bit_table(df: DataFrame, column: str) -> np.ndarray:
    """A bit for each hash of ``column``: no hash that is there is missed, some others pass.

    It thins a scan before an exact join.  The table has 2**27 bits at every size of input.
    """
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hash_bits(batch.column(0).to_numpy()))], names=["bit"])

    bits = df.select(F.col(column).cast("long")).mapInArrow(run, "bit long")
    rows = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("v")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[rows["at"].to_numpy()] = rows["v"].to_numpy()
    return table


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hash_bits(hashes)
    return (table[bit >> 6] >> (bit & 63)) & 1 == 1


def merged(rows: DataFrame) -> DataFrame:
    """One row per document of ``rows`` (doc_id, start, end, first_doc): doc_id, n_repeated, spans, first_docs.

    ``spans`` are disjoint (start, end) in words, ascending; ``n_repeated`` counts their
    words; ``first_docs`` lists the documents in which the repeated text comes first.
    A document's spans are no more than its words.
    """
    found = rows.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("all"),
                                       F.array_sort(F.collect_set("first_doc")).alias("first_docs"))
    schema = "doc_id long, n_repeated long, spans array<struct<start:int,end:int>>, first_docs array<long>"

    def run(batches):
        for batch in batches:
            out = []
            for spans in batch.column(1):
                items = spans.values
                start, end = items.field("start").to_numpy(), items.field("end").to_numpy()
                reach = np.maximum.accumulate(end)
                new = np.r_[True, start[1:] > reach[:-1]]
                at = np.flatnonzero(new)
                out.append((start[at], reach[np.r_[at[1:] - 1, len(end) - 1]]))
            border = np.cumsum([0, *(len(s) for s, _ in out)]).astype(np.int32)
            flat = lambda i: np.concatenate([o[i] for o in out]).astype(np.int32) if out else np.empty(0, np.int32)  # noqa: B023, E731
            pairs = pa.StructArray.from_arrays([pa.array(flat(0)), pa.array(flat(1))], names=["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int((e - s).sum()) for s, e in out], pa.int64()),
                 pa.ListArray.from_arrays(border, pairs), batch.column(2)], names=["doc_id", "n_repeated", "spans", "first_docs"])

    return found.mapInArrow(run, schema)


def cut(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) without the words of ``spans`` and the signs up to the next word."""
    both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        repeats.select("doc_id", "spans"), "doc_id", "left")

    def run(batches):
        for batch in batches:
            raw, offsets = W.text_bytes(batch.column(1))
            texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, j, words in W.each_slice(batch.column(1)):
                for t in (t for t in range(i, j) if spans[t] and texts[t]):
                    data, base = raw[offsets[t] : offsets[t + 1]].tobytes(), offsets[t] - offsets[i]
                    start = np.r_[words.start[words.first[t - i] : words.first[t - i + 1]] - base, len(data)]
                    kept, at = [], 0
                    for span in spans[t]:
                        kept.append(data[at : start[span["start"]]])
                        at = start[span["end"]]
                    texts[t] = b"".join([*kept, data[at:]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return both.mapInArrow(run, "doc_id long, text string")
