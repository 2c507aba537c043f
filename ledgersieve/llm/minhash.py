"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A document is its set of five-word shingles; a shingle that occurs ``c`` times weighs
``1 + ln(c)``.  Each shingle is a Poisson process whose rate is its weight: it emits
arrival times, each falling on one of the signature's components.  A component keeps the
shingle that arrives first, so two documents agree in a component with the probability
Jaccard similarity of their weighted shingles.  A shingle whose next arrival is later
than the latest first arrival of the document ends early; all shingles of a batch go
through these rounds together.

Repeats that two texts do not share lower that probability below their plain similarity.
So a text in which a shingle repeats has the bands of a second signature too, in which all
shingles weigh one; those of other texts are the same in both, so any two texts meet by
their plain similarity as well.

Documents that agree in one band of components are candidates.  The plain Jaccard
similarity of the two shingle sets, computed from the texts, decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.components import components
from ledgersieve.llm.store import lean, text_key, without, written

SHINGLE, SIMILARITY = 5, 0.8
#: A pair at plain similarity 0.8 is missed by all bands with probability (1 - 0.8**4)**20 = 3e-5 at most.
BANDS, ROWS = 20, 4
#: Bits of the fixed-size filter that thins the second scan of the texts.
FILTER_BITS = 24
U = np.uint64


def shingle_sets(words: W.Words, k: int):
    """Distinct shingle hashes of each text of a slice: (text, hash, count), sorted.

    A text of fewer than ``k`` words, but not none, is one shingle.
    """
    hashes, at = W.grams(words.hash, words.first, k)
    owner = np.searchsorted(words.first, at, "right") - 1
    size = np.diff(words.first)
    for n in range(1, k):
        few = np.flatnonzero(size == n)
        if len(few):
            at = words.first[few]
            hashes = np.r_[hashes, W.span_hash(words.hash, at, at + n)]
            owner = np.r_[owner, few]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    place = np.flatnonzero(new)
    return owner[place], hashes[place], np.diff(np.r_[place, len(hashes)])


def signatures(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """ProbMinHash signatures, (texts, m); the value is the hash of the first shingle to arrive."""
    best = np.full(texts * m, np.inf)
    kept = np.zeros(texts * m, np.uint64)
    alive, clock, turn = np.arange(len(hashes)), np.zeros(len(hashes)), 0
    while len(alive):
        draw = W.mix(hashes[alive] + U((2 * turn + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
        uniform = ((draw >> U(11)).astype(np.float64) + 0.5) * 2.0**-53
        clock = clock - np.log(uniform) / weight[alive]
        part = W.mix(draw ^ U(0x8CB92BA72F3D8DD7)) % U(m)
        cell = owner[alive] * m + part.astype(np.int64)
        np.minimum.at(best, cell, clock)
        won = best[cell] == clock
        kept[cell[won]] = hashes[alive[won]]
        latest = best.reshape(texts, m).max(axis=1)
        stay = clock < latest[owner[alive]]
        alive, clock, turn = alive[stay], clock[stay], turn + 1
    return kept.reshape(texts, m)


def _band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = np.zeros((len(values), bands), np.uint64)
        for r in range(rows):
            keys = W.mix(keys * U(31) + values[:, r::rows][:, :bands] + U(r + 1))
        return W.mix(keys + np.arange(1, bands + 1, dtype=np.uint64)).view(np.int64)


def _set_key(owner: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """16 bytes that stand for a shingle set: two sums over differently mixed members."""
    out = np.zeros((texts, 2), np.uint64)
    border = np.searchsorted(owner, np.arange(texts + 1))
    for side, salt in enumerate((0x632BE59BD9B4E019, 0xE220A8397B1DCDAF)):
        with np.errstate(over="ignore"):
            sums = np.r_[U(0), np.cumsum(W.mix(hashes ^ U(salt)), dtype=np.uint64)]
            out[:, side] = sums[border[1:]] - sums[border[:-1]]
    return out


def _keys_array(keys: np.ndarray, known: np.ndarray) -> pa.Array:
    raw = keys.astype(">u8").tobytes()
    return pa.array([raw[i * 16 : i * 16 + 16] if ok else None for i, ok in enumerate(known)], pa.binary())


def _bands(owner: np.ndarray, hashes: np.ndarray, count: np.ndarray, texts: int, bands: int, rows: int) -> pa.Array:
    """Band keys of each text: those by weight, and if a shingle repeats those of equal weights too."""
    keys = _band_keys(signatures(owner, hashes, 1 + np.log(count), texts, bands * rows), bands, rows)
    again = np.zeros(texts, bool)
    again[owner[count > 1]] = True
    part = again[owner]
    number = np.cumsum(again) - 1
    plain = _band_keys(signatures(number[owner[part]], hashes[part], np.ones(int(part.sum())), int(again.sum()), bands * rows), bands, rows)
    border = np.r_[0, np.cumsum(bands * (1 + again))].astype(np.int32)
    values = np.empty(border[-1], np.int64)
    values[border[:-1, None] + np.arange(bands)] = keys
    values[border[:-1][again, None] + bands + np.arange(bands)] = plain
    return pa.ListArray.from_arrays(border, pa.array(values))


def _bits(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids.astype(np.uint64)) >> U(64 - FILTER_BITS)).astype(np.int64)


def sketches(docs: DataFrame, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, key, node, n_shingles, bands): node stands for the shingle set, null without words."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, words in W.each_slice(batch.column(1)):
                owner, hashes, count = shingle_sets(words, k)
                n = np.diff(np.searchsorted(owner, np.arange(j - i + 1)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), batch.column(2).slice(i, j - i),
                     _keys_array(_set_key(owner, hashes, j - i), n > 0), pa.array(n),
                     _bands(owner, hashes, count, j - i, bands, rows)],
                    names=["doc_id", "key", "node", "n_shingles", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key()).mapInArrow(
        lean(run), "doc_id long, key long, node binary, n_shingles long, bands array<long>")


def _shingles(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, sid, shingles) of the candidate ``nodes`` (node, doc_id), written; sid numbers the rows.

    A bit table of fixed size (2**24 bits, whatever the input) thins the scan, so that
    only candidates' texts are shingled again and shuffled; the join behind it is exact.
    """
    word = F.expr(f"shiftright(bit, 6)").alias("word")
    bits = (nodes.select("doc_id").mapInArrow(
        lambda it: (pa.RecordBatch.from_arrays(
            [pa.array(_bits(np.asarray(b.column(0).fill_null(0), np.int64)))], names=["bit"]) for b in it), "bit long")
        .groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("v")).collect())
    filled = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    filled[[r["word"] for r in bits]] = [r["v"] for r in bits]
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches):
        for batch in batches:
            ids = _bits(np.asarray(batch.column(0).fill_null(0), np.int64))
            hit = (shared.value[ids >> 6] >> (ids & 63)) & 1
            batch = batch.take(pa.array(np.flatnonzero(hit)))
            for i, j, words in W.each_slice(batch.column(1)):
                owner, hashes, _ = shingle_sets(words, k)
                border = np.searchsorted(owner, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), _keys_array(_set_key(owner, hashes, j - i), np.diff(border) > 0),
                     pa.ListArray.from_arrays(border.astype(np.int32), pa.array(hashes.view(np.int64)))],
                    names=["doc_id", "node", "shingles"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lean(run), "doc_id long, node binary, shingles array<long>").where("node is not null")
    wanted = nodes.select("node", F.coalesce("doc_id", F.lit(0)).alias("w_id"))
    one = found.join(wanted, (found.node == wanted.node) & (F.coalesce(found.doc_id, F.lit(0)) == wanted.w_id), "left_semi")
    one = one.dropDuplicates(["node"])
    return written(one.select("node", F.monotonically_increasing_id().alias("sid"), "shingles"), "shingles")


def _bounds(sets: DataFrame) -> DataFrame:
    """(node, n, own) of each candidate, written: its shingles, and those no other candidate has."""
    lone = (sets.select("sid", F.explode("shingles").alias("s")).groupBy("s").agg(
        F.count(F.lit(1)).alias("c"), F.min("sid").alias("sid")).where("c = 1").groupBy("sid").agg(
        F.count(F.lit(1)).alias("own")))
    return written(sets.select("node", "sid", F.size("shingles").alias("n")).join(lone, "sid", "left").select(
        "node", "n", F.coalesce("own", F.lit(0)).cast("int").alias("own")), "bounds")


def _anchored(members: DataFrame, hubs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, anchor, shared): one hub for each member, the same for most of a group, and what they have in common."""
    near = members.join(hubs, "band").groupBy("node").agg(F.max_by("hub", F.struct("hub_met", "hub")).alias("anchor"))
    a = sets.select("node", F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("anchor"), F.col("shingles").alias("sb"))
    return written(near.join(a, "node").join(b, "anchor").select(
        "node", "anchor", F.size(F.array_intersect("sa", "sb")).alias("shared")), "anchors")


def _possible(threshold: float, a: str, b: str):
    """False only where two sets can't be ``threshold`` alike; exact, from counts alone.

    Shingles that one set has alone can't be common.  If both have the same anchor, what
    is common lies in the anchor, or outside it and is alone in neither.
    """
    of = lambda side, name: F.col(f"{side}_{name}")
    n, own, shared = (lambda side: of(side, "n")), (lambda side: of(side, "own")), (lambda side: of(side, "shared"))
    common = F.least(n(a) - own(a), n(b) - own(b))
    outside = F.greatest(F.least(n(a) - shared(a) - own(a), n(b) - shared(b) - own(b)), F.lit(0))
    same = of(a, "anchor") == of(b, "anchor")
    common = F.when(same, F.least(common, F.least(shared(a), shared(b)) + outside)).otherwise(common)
    return common >= F.lit(threshold) * (n(a) + n(b) - common)


def _sided(side: str, *names: str):
    return [F.col(c).alias(f"{side}_{c}") for c in names]


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose shingle sets are at least ``threshold`` alike."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= F.lit(threshold) * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, n_links, keep.

    ``class_id`` is the smallest doc_id of the documents that links of ``threshold``
    similarity or more connect; ``n_links`` counts the verified links of the document's
    shingle set with other sets; ``keep`` is true for one document of a class (the
    smallest doc_id, null last; rows that repeat it share the answer).  Documents with the same shingle set are one node, however many.

    In a bucket of a band, all members are compared with its hub, then with a few pivots;
    members that are by then in a pivot's class need no further comparison, the others go
    on to more pivots, until each pair of a bucket is in one class, has been compared, or
    is ruled out by an exact bound: shingles that only one candidate has can't be common.
    So nothing is capped, and a group of thousands of copies costs a few rows per member.

    Null and empty texts, and texts without words, are alone in their class; null
    doc_ids are allowed; rows that repeat are members of one class; other columns are
    left aside.  An empty table gives no rows.
    """
    return _classes(docs, k, threshold, bands, rows).drop("key")


def kept(docs: DataFrame, k: int = SHINGLE, threshold: float = SIMILARITY) -> DataFrame:
    """Rows of ``docs``, with all their columns, that ``near_duplicates`` keeps."""
    return without(docs, _classes(docs, k, threshold, BANDS, ROWS).where(~F.col("keep")))


def _classes(docs: DataFrame, k: int, threshold: float, bands: int, rows: int) -> DataFrame:
    rows_of = written(sketches(docs, k, bands, rows), "sketches")
    nodes = written(rows_of.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("bands", F.coalesce("doc_id", F.lit(-1))).alias("bands")), "nodes")
    members = nodes.select("node", F.explode(F.array_distinct("bands")).alias("band"))
    crowded = members.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    members = written(members.join(crowded, "band"), "members")
    sets = _shingles(docs, nodes.join(members, "node", "left_semi").select("node", "doc_id"), k)
    bounds = _bounds(sets)

    # A set that has too many shingles alone is like no other.  The hub of a bucket is the
    # member that meets the most others in all bands: near the text that was copied.
    able = bounds.where(F.col("n") - F.col("own") >= F.lit(threshold) * F.col("n"))
    met = members.groupBy("node").agg(F.sum("c").alias("met"))
    members = written(members.select("band", "node").join(able, "node").join(met, "node"), "members")
    hubs = members.groupBy("band").agg(F.max_by("node", F.struct("met", "node")).alias("hub"), F.max("met").alias("hub_met"))
    hubs = written(hubs, "hubs")
    facts = ("node", "n", "own", "anchor", "shared")
    anchors = _anchored(members, hubs, sets)
    members = written(members.join(anchors, "node"), "members")
    about = members.select(*facts).distinct()
    pairs = (members.join(hubs, "band").where("node <> hub").select("hub", "node").distinct()
             .join(about.select(*_sided("x", *facts)).withColumnRenamed("x_node", "node"), "node")
             .join(about.select(*_sided("y", *facts)).withColumnRenamed("y_node", "hub"), "hub")
             .where(_possible(threshold, "x", "y"))
             .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())
    tried = written(pairs, "pairs")
    links = written(_linked(tried, sets, threshold), "links")
    pivots, grown = 16, True
    while True:
        if grown:
            roots = written(components(links), "roots")
        now = members.join(roots, "node", "left").select(
            "band", *facts, "met", F.coalesce("root", "node").alias("root"))
        mixed = now.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                        F.count(F.lit(1)).alias("size")).where("lo <> hi").select("band", "size")
        now = written(now.join(mixed, "band"), "mixed")
        left = now.agg(F.max("size")).first()[0]
        grown = False
        if left is None:
            break
        order = Window.partitionBy("band").orderBy(F.desc("met"), "node")
        heads = now.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots)
        heads = heads.select(F.col("band").alias("y_band"), *_sided("y", *facts, "root", "met"))
        others = now.select("band", *_sided("x", *facts, "root", "met"))
        # Of two pivots the later meets the earlier, so no pair is made twice.
        after = (F.col("y_met") > F.col("x_met")) | ((F.col("y_met") == F.col("x_met")) & (F.col("y_node") < F.col("x_node")))
        fresh = (others.join(heads, (F.col("band") == F.col("y_band")) & after & (F.col("x_root") != F.col("y_root")) & _possible(threshold, "x", "y"))
                 .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
                 .join(tried, ["a", "b"], "left_anti"))
        fresh = written(fresh, "pairs")
        if not fresh.isEmpty():
            tried = tried.unionByName(fresh)
            more = written(_linked(fresh, sets, threshold), "links")
            if not more.isEmpty():
                links, grown = links.unionByName(more), True
        if pivots >= left:
            break
        pivots *= 32
    if grown:
        roots = written(components(links), "roots")
    degree = (links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    classes = (nodes.select("node", F.col("doc_id").alias("low")).join(roots, "node", "left")
               .select("node", "low", F.coalesce("root", "node").alias("root")))
    named = rows_of.groupBy("node").agg(F.count(F.lit(1)).alias("copies")).where("node is not null")
    named = classes.join(named, "node").groupBy("root").agg(
        F.min("low").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("low").isNull(), "low", "node")).getField("node").alias("first"))
    placed = (classes.join(named, "root").join(degree, "node", "left")
              .select("node", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      (F.col("node") == F.col("first")).alias("leads"), F.col("low")))
    out = rows_of.select("doc_id", "key", "node").join(placed, "node", "left")
    return out.select(
        "doc_id", "key", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("node").isNull(), True).otherwise(
            F.col("leads") & F.col("doc_id").eqNullSafe(F.col("low"))).alias("keep"))
