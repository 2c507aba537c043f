"""Toxicity scores by logistic regression with the FTRL-proximal rule.

Features are the distinct hashed words, word pairs and skip-grams (one or two words left
out between) of the whole text.  FTRL-proximal keeps two numbers per coordinate, so each
coordinate has its own learning rate, and its L1 term leaves most weights exactly zero.
Only the non-zero weights are kept; they are what scoring broadcasts.  The bias has no L1
term.  Where no coordinate but the bias has a weight, nothing tells texts apart: every
text then scores 0.

Training is parameter mixing: Spark deals the labelled rows to shards, each
runs the sequential rule over its rows, and a coordinate's weight is the mean over
the shards.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.store import lean, written

#: Coordinates of the hashed feature space; with 2**24, a text of 1,000 words meets a given
#: coordinate by chance with probability 2e-4.
SPACE_BITS = 24
#: Bound of the training sample, in documents.  Labelled rows beyond it are thinned by a hash.
MAX_ROWS = 40_000
#: Training rows and bytes of text of a shard, about; less makes fewer shards.
SHARD_ROWS, SHARD_BYTES, EPOCHS = 10_000, 1 << 26, 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 6.0, 0.0
BIAS = 0
#: Bytes of text whose features are found at once; they take some thirty times as much.
SLICE_BYTES = 1 << 18


class Weights(NamedTuple):
    place: np.ndarray  # ascending coordinates
    value: np.ndarray


def features(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, borders per text): distinct features of each text of a slice."""
    h, first = words.hash, words.first
    owner = words.owner()
    shift = np.uint64(64 - SPACE_BITS)
    coordinates, owners = [W.mix(h) >> shift], [owner]
    with np.errstate(over="ignore"):
        for gap in (1, 2, 3):
            if len(h) > gap:
                same = owner[:-gap] == owner[gap:]
                pair = W.mix(h[:-gap] * np.uint64(2 * gap + 1) + (h[gap:] ^ np.uint64(gap)))
                coordinates.append(pair[same] >> shift)
                owners.append(owner[:-gap][same])
    key = np.unique((np.concatenate(owners).astype(np.uint64) << np.uint64(SPACE_BITS)) | np.concatenate(coordinates))
    place = (key & np.uint64((1 << SPACE_BITS) - 1)).astype(np.int32)
    return place, np.searchsorted(key >> np.uint64(SPACE_BITS), np.arange(len(first)))


class Rows:
    """(coordinates, label) of a shard's rows, with the bias; kept as few large arrays."""

    def __init__(self):
        self.parts = []

    def add(self, place: np.ndarray, border: np.ndarray, labels: np.ndarray) -> None:
        self.parts.append((place.copy(), border, labels))

    def __iter__(self):
        for place, border, labels in self.parts:
            for a, b, label in zip(border[:-1].tolist(), border[1:].tolist(), labels.tolist()):
                yield np.r_[np.int32(BIAS), place[a:b]], label


def ftrl(rows: Iterable[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> Weights:
    """Run the rule over (coordinates, label) rows in order; weights that are not zero."""
    z = np.zeros(1 << SPACE_BITS, np.float32)
    n = np.zeros(1 << SPACE_BITS, np.float32)

    def weights(zi, ni, place):
        least = np.where(place == BIAS, 0.0, L1)
        return np.where(np.abs(zi) <= least, 0.0, -(zi - np.sign(zi) * least) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for place, label in rows:
            zi, ni = z[place], n[place]
            w = weights(zi, ni, place)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            more = ni + gradient * gradient
            z[place] = zi + gradient - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
            n[place] = more
    heavy = z > L1
    heavy |= z < -L1
    heavy[BIAS] = z[BIAS] != 0
    kept = np.flatnonzero(heavy)
    return Weights(kept, weights(z[kept], n[kept], kept))


def sample(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, label, h): about ``max_rows`` labelled documents at most, whose labels may be used.

    They are chosen by a hash of doc_id, so the choice is the same in every run.  Rows
    without a label or a doc_id are left out; a doc_id with several labels is toxic if
    one says so.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where(
        "label is not null and doc_id is not null").where(fold() != 0)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    total = known.count()
    if total > max_rows:
        known = known.where(F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < int(max_rows / total * (1 << 20)))
    return known


def train(docs: DataFrame, labelled: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> DataFrame:
    """(place, weight) learnt from the texts of ``docs`` that ``labelled`` (doc_id, label, h) names.

    ``labelled`` has at most about ``max_rows`` rows, and is broadcast for that.  Rows of
    one shard are taken in the order of the hash.  No labelled row gives no weights.
    """
    labelled = F.broadcast(labelled)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(labelled, "doc_id")
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-size["rows"] // SHARD_ROWS), -(-size["bytes"] // SHARD_BYTES))

    def run(batches):
        rows, last = Rows(), None

        def learnt():
            found = ftrl(rows, epochs)
            return pa.RecordBatch.from_arrays([pa.array(found.place), pa.array(found.value.astype(np.float64))], names=["place", "weight"])

        for batch in batches:
            labels, shard = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, j, words in W.each_slice(batch.column(0), budget=SLICE_BYTES):
                place, border = features(words)
                # Shards that meet in one task are learnt one after the other.
                for a in [i, *(np.flatnonzero(shard[i + 1 : j] != shard[i : j - 1]) + i + 1).tolist()]:
                    b = i + int(np.searchsorted(shard[i:j], shard[a], "right"))
                    if last is not None and shard[a] != last:
                        yield learnt()
                        rows = Rows()
                    last = shard[a]
                    rows.add(place[border[a - i] : border[b - i]], border[a - i : b - i + 1] - border[a - i], labels[a:b])
        if last is not None:
            yield learnt()

    shard = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards)).cast("int")
    dealt = rows.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "h", "text")
    learnt = dealt.select("text", "label", "shard").mapInArrow(lean(run), "place long, weight double")
    return learnt.groupBy("place").agg((F.sum("weight") / shards).alias("weight"))


def collected(weights: DataFrame) -> Weights:
    """The weights as sorted arrays; a coordinate has one, so they are 2**24 at most and, as a rule, some thousands."""
    table = weights.orderBy("place").toArrow()
    return Weights(table["place"].to_numpy().astype(np.int64), table["weight"].to_numpy())


def learnt(weights: Weights) -> bool:
    """Whether any coordinate but the bias has a weight."""
    return bool(np.any((weights.place != BIAS) & (weights.value != 0)))


def _scores(weights: Weights):
    """A function from an array of texts to their scores.

    A table of bits tells which coordinates have a weight (2 MB, which stays in a core's cache);
    only those few are looked up.
    """
    bits = np.zeros(1 << SPACE_BITS - 3, np.uint8)
    np.bitwise_or.at(bits, weights.place >> 3, np.uint8(1) << (weights.place & 7).astype(np.uint8))
    value = weights.value.astype(np.float32)
    bias = value[weights.place == BIAS].sum()

    def run(texts: pa.Array) -> np.ndarray:
        out = [np.empty(0)]
        for _, _, words in W.each_slice(texts, budget=SLICE_BYTES):
            found, border = features(words)
            hit = np.flatnonzero((bits[found >> 3] >> (found & 7).astype(np.uint8)) & 1)
            sums = np.r_[0.0, np.cumsum(value[np.searchsorted(weights.place, found[hit])], dtype=np.float64)]
            at = np.searchsorted(hit, border)
            out.append(bias + sums[at[1:]] - sums[at[:-1]])
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -35, 35)))

    return run


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """``docs`` (doc_id, text) with score, 0 to 1; null and empty texts get the score of the bias, all texts 0 if nothing is learnt."""
    if not learnt(weights):
        return docs.select(F.col("doc_id").cast("long"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        scores = _scores(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1)))],
                                             names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lean(run), "doc_id long, score double")


def kept(docs: DataFrame, weights: Weights) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose ``score`` is below one half."""
    if not learnt(weights):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    place = docs.columns.index("text")

    def run(batches):
        scores = _scores(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(place)) < 0.5))

    return docs.mapInArrow(lean(run), docs.schema)


def fold() -> "F.Column":
    """crc32 of the decimal doc_id mod 5; 0 is held out of training."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def model(docs: DataFrame, labels: DataFrame) -> Weights:
    """Weights learnt from the documents whose labels may be used."""
    return collected(written(train(docs, written(sample(labels), "labelled")), "toxicity"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Learns ``labels.toxic`` from rows whose crc32(doc_id) mod 5 is not 0.  A null doc_id is not held out (false)
    and is scored like any other; repeated rows are scored each.  If nothing is learnt (no
    usable label, or too few), every text scores 0.
    """
    scored = score(docs, model(docs, labels))
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
