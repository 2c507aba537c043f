"""Ranked lexical search by geometric blocks of each term's posting list.

The documents are ordered by a similarity code (signs of projections of their impact
vectors, in Gray order) and range-partitioned by it.  Inside a run of similar documents
the posting list of each term is cut into blocks of neighbours, and each block stores the
largest impact of every coordinate over its documents, as exact integers.  A query's
product with that summary bounds the score of each document of the block.

1. The blocks of largest bound give each query documents, which are scored exactly; their
   20th score is the query's threshold.
2. A query's lists are ordered by their largest impact.  Lists that can't reach the
   threshold all together are left out; of the others, a block is skipped only if its
   bound is below the threshold.  So every document that may still be among the best
   stands in a block that is taken, and all documents of such blocks are scored exactly.

Queries are a given set, taken in groups of about ``Shape.terms`` terms; a group's terms and
weights are broadcast for that bound.  Coordinates that no query holds together with a
list's term never enter a bound of that list, so its summaries leave them out.
All sums are 64-bit integers.  Postings of a frequent term are dealt over all ranges, as
documents are; no task holds more of a list than the documents of its run.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.store import parted, parts, written
from ledgersieve.llm.winnow import word_list

BEST = 20
CODE_BITS = 16


class Shape(NamedTuple):
    """Sizes of groups, runs and blocks; no result depends on them."""

    terms: int = 1 << 13       # query terms of a group, on average, as queries are dealt by a hash
    queries: int = 512         # queries of a group, likewise
    cells: int = 1 << 23       # documents of a run times terms of the group: 64 MB of impacts in a task
    least_block: int = 16      # documents of a block at least, but for the rest of a list
    list_blocks: int = 8       # blocks of a list in a run at most
    seed_blocks: int = 16      # blocks whose documents give a query's threshold
    width: int = 512           # places of a summary; lists that meet more terms share them


class Queries(NamedTuple):
    """A group of queries over a vocabulary of its own."""

    terms: pa.Array            # distinct terms
    ids: np.ndarray            # query numbers, ascending
    first: np.ndarray          # borders of each query in the two below
    term: np.ndarray           # terms of a query
    times: np.ndarray          # how often the query has them
    shape: Shape

    def coordinates(self) -> list[np.ndarray | None]:
        """For each term, ascending: all terms that share a query with it; None beyond the width."""
        holders = [[] for _ in range(len(self.terms))]
        for q, (a, b) in enumerate(zip(self.first[:-1], self.first[1:])):
            for t in self.term[a:b].tolist():
                holders[t].append(q)
        found = []
        for queries in holders:
            size = max((int(self.first[q + 1] - self.first[q]) for q in queries), default=0)
            near = np.unique(np.concatenate([self.term[self.first[q] : self.first[q + 1]] for q in queries])) if 0 < size <= self.shape.width else None
            found.append(near if near is not None and len(near) <= self.shape.width else None)
        return found

    def holders(self, used: np.ndarray) -> list[list[int]]:
        """For each term the queries that use its list."""
        of = [[] for _ in range(len(self.terms))]
        for q, (a, b) in enumerate(zip(self.first[:-1], self.first[1:])):
            for t in self.term[a:b][used[a:b]].tolist():
                of[t].append(q)
        return of


def summary_places(near: np.ndarray | None, terms: np.ndarray, width: int) -> np.ndarray:
    """Where a list's summaries have these terms; beyond the width several share a place, which holds their maximum."""
    return terms % width if near is None else np.searchsorted(near, terms)


class Ranking(NamedTuple):
    """What an impact depends on besides the document."""

    n_docs: int
    n_words: int
    weight: np.ndarray         # of each term

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        length = 100 - 25 + (25 * n * self.n_docs) // max(self.n_words, 1)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length))


def queries_of(rows: pa.Table, shape: Shape = Shape()) -> Queries:
    """From rows (query, term, times) of one group."""
    rows = rows.sort_by([("query", "ascending"), ("term", "ascending")])
    coded = rows["term"].combine_chunks().dictionary_encode()
    query = rows["query"].to_numpy()
    ids, first = np.unique(query, return_index=True)
    return Queries(coded.dictionary, ids, np.r_[first, len(query)], coded.indices.to_numpy().astype(np.int64), rows["times"].to_numpy(), shape)


def word_strings(found: W.Words) -> pa.Array:
    """The words themselves, without their gaps."""
    length = found.end - found.start
    to = np.r_[0, np.cumsum(length)]
    at = np.arange(to[-1]) + np.repeat(found.start - to[:-1], length)
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(found.text[at]))


def forward(docs: DataFrame, queries: Queries) -> DataFrame:
    """(ref, doc_id, n, terms, tfs) of each row of ``docs``, for the terms of the group; written.

    ``ref`` is a number given when the table is written, so rows that repeat stay apart.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(queries.terms.cast(pa.large_string()))

    def run(batches):
        vocabulary = shared.value
        size = len(vocabulary)
        for batch in batches:
            for i, j, found in W.each_slice(batch.column(1)):
                place = pc.index_in(word_strings(found), value_set=vocabulary)
                known = np.flatnonzero(np.asarray(place.is_valid()))
                key, tf = np.unique(found.owner()[known] * size + place.take(pa.array(known)).to_numpy().astype(np.int64), return_counts=True)
                border = pa.array(np.searchsorted(key, np.arange(j - i + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(found.first).astype(np.int64)),
                     pa.ListArray.from_arrays(border, pa.array((key % size).astype(np.int32))),
                     pa.ListArray.from_arrays(border, pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<int>")
    kept = written(rows.select(F.monotonically_increasing_id().alias("ref"), "*"), "forward")
    shared.destroy()
    return kept


def ranking(vectors: DataFrame, size: int) -> Ranking:
    """Counts over all documents; a row for each term of the group comes to the driver."""
    n_docs, n_words = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(size, np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[r["term"]] = r["count"]
    return Ranking(n_docs, n_words, np.floor(1000 * np.log((2 * n_docs + 2) / (2 * holding + 1))).astype(np.int64))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(borders, values) of a list column."""
    return column.offsets.to_numpy().astype(np.int64) - column.offsets[0].as_py(), column.flatten().to_numpy().astype(np.int64)


def _impacts(batch, rank: Ranking) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(borders, terms, impacts) of the rows of a batch."""
    border, term = _flat(batch.column("terms"))
    tf = _flat(batch.column("tfs"))[1]
    n = np.repeat(batch.column("n").to_numpy(), np.diff(border))
    return border, term, rank.impacts(term, tf, n)


def coded(vectors: DataFrame, rank: Broadcast, size: int) -> DataFrame:
    """``vectors`` with postings, and their similarity ``code``: near vectors agree in most signs."""
    def run(batches):
        signs = np.random.default_rng(13).choice(np.array([-1.0, 1.0], np.float32), (size, CODE_BITS))
        for batch in batches:
            border, term, impact = _impacts(batch, rank.value)
            code = np.zeros(batch.num_rows, np.int64)
            for bit in range(CODE_BITS):
                sums = np.r_[0.0, np.cumsum(impact * signs[term, bit])]
                code |= (sums[border[1:]] > sums[border[:-1]]).astype(np.int64) << bit
            for shift in (1, 2, 4, 8):  # place of the code in Gray order, in which neighbours differ by one sign
                code ^= code >> shift
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), *batch.columns], names=["code", *batch.schema.names])

    rows = vectors.where(F.size("terms") > 0).select("ref", "n", "terms", "tfs")
    return rows.mapInArrow(run, "code int, ref long, n long, terms array<int>, tfs array<int>")


def blocks(vectors: DataFrame, queries: Queries, rank: Ranking) -> DataFrame:
    """(term, top, refs, maxima): blocks of all posting lists; written.

    ``top`` is the largest impact of the term itself, ``maxima`` those at its ``summary_places``.
    """
    spark, size, shape = vectors.sparkSession, len(queries.terms), queries.shape
    shared, coordinates = spark.sparkContext.broadcast(rank), spark.sparkContext.broadcast(queries.coordinates())

    def cut(refs, doc, term, impact):
        """Blocks of the documents of a run, whose postings are (doc, term, impact)."""
        table = np.zeros((len(refs), size), np.int64)
        table[doc, term] = impact
        keep = impact > 0
        order = np.argsort(term[keep] * len(refs) + doc[keep])
        doc, term = doc[keep][order], term[keep][order]
        names, first = np.unique(term, return_index=True)
        folded = np.pad(table, ((0, 0), (0, -size % shape.width))).reshape(len(refs), -1, shape.width).max(axis=1)
        out_term, tops, sizes, widths, maxima = [], [], [], [], []
        for t, a, b in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(term)]):
            step = max(shape.least_block, -(-(b - a) // shape.list_blocks))
            starts = np.arange(0, b - a, step)
            near = coordinates.value[t]
            top = np.maximum.reduceat(folded[doc[a:b]] if near is None else table[np.ix_(doc[a:b], near)], starts, axis=0)
            out_term += [t] * len(starts)
            tops.append(np.maximum.reduceat(table[doc[a:b], t], starts))
            sizes.append(np.diff(np.r_[starts, b - a]))
            widths.append(np.full(len(starts), top.shape[1]))
            maxima.append(top.ravel())
        lists = lambda n, v: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.concatenate(n))].astype(np.int32)), pa.array(v))
        return pa.RecordBatch.from_arrays([pa.array(out_term, pa.int32()), pa.array(np.concatenate(tops)), lists(sizes, refs[doc]), lists(widths, np.concatenate(maxima))],
                                          names=["term", "top", "refs", "maxima"])

    def run(batches):
        most, held, have = max(1, shape.cells // size), [], 0

        def emptied():
            refs, docs, terms, impacts = (np.concatenate(x) for x in zip(*held))
            if impacts.any():
                yield cut(refs, docs, terms, impacts)

        for batch in batches:
            border, term, impact = _impacts(batch, shared.value)
            refs, at = batch.column("ref").to_numpy(), 0
            while at < len(refs):
                to = min(len(refs), at + most - have)
                a, b = border[at], border[to]
                held.append((refs[at:to], have + np.repeat(np.arange(to - at), np.diff(border[at : to + 1])), term[a:b], impact[a:b]))
                have, at = have + to - at, to
                if have == most:
                    yield from emptied()
                    held, have = [], 0
        if held:
            yield from emptied()

    ranged = coded(vectors, shared, size).repartitionByRange(parts(spark), "code", "ref").sortWithinPartitions("code", "ref")
    kept = written(ranged.select("ref", "n", "terms", "tfs").mapInArrow(run, "term int, top long, refs array<long>, maxima array<long>"), "blocks")
    shared.destroy()
    coordinates.destroy()
    return kept


def _bounds(batch, queries: Queries, holders, coordinates):
    """(block rows, query, bounds) of each list of a batch and each query that uses it."""
    border, values = _flat(batch.column("maxima"))
    terms = batch.column("term").to_numpy()
    order = np.argsort(terms, kind="stable")
    names, first = np.unique(terms[order], return_index=True)
    for t, a, b in zip(names.tolist(), first, [*first[1:], len(order)]):
        rows = order[a:b]
        for q in holders[t]:
            mine = slice(queries.first[q], queries.first[q + 1])
            at = summary_places(coordinates[t], queries.term[mine], queries.shape.width)
            yield rows, q, values[border[rows][:, None] + at] @ queries.times[mine]


def _lists(values: np.ndarray, border: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``rows`` of a list column, and how many each has."""
    count = border[rows + 1] - border[rows]
    ends = np.cumsum(count)
    return values[np.repeat(border[rows] - ends + count, count) + np.arange(count.sum())], count


def _chosen(cut: DataFrame, queries: Queries, used: np.ndarray, schema: str, pick) -> tuple:
    """``pick`` over the bounds of all blocks: the rows, and what to release when they are written."""
    shared = cut.sparkSession.sparkContext.broadcast((queries, queries.holders(used), queries.coordinates()))

    def run(batches):
        for batch in batches:
            border, refs = _flat(batch.column("refs"))
            yield from pick(_bounds(batch, *shared.value), border, refs)

    return cut.mapInArrow(run, schema), shared


def seeds(cut: DataFrame, queries: Queries) -> DataFrame:
    """(ref, query): documents of each query's blocks of largest bound; written."""
    most = queries.shape.seed_blocks

    def pick(bounds, border, refs):
        found = [(rows, np.full(len(rows), q), bound) for rows, q, bound in bounds]
        if not found:
            return
        row, query, bound = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-bound, query))
        row, query, bound = row[order], query[order], bound[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        row, query, bound = (x[place < most] for x in (row, query, bound))
        value, count = _lists(refs, border, row)
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(bound), pa.ListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(value))], names=["query", "bound", "refs"])

    rows, shared = _chosen(cut, queries, np.ones(len(queries.term), bool), "query int, bound long, refs array<long>", pick)
    first = Window.partitionBy("query").orderBy(F.desc("bound"), "refs")
    rows = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= most)
    kept = written(rows.select(F.explode("refs").alias("ref"), "query").distinct(), "seeds")
    shared.destroy()
    return kept


def candidates(cut: DataFrame, queries: Queries, least: np.ndarray) -> DataFrame:
    """(ref, query) of all documents that may score ``least`` of their query or more; written."""
    largest = np.zeros(len(queries.terms), np.int64)
    for r in cut.groupBy("term").agg(F.max("top").alias("top")).collect():
        largest[r["term"]] = r["top"]
    used = np.zeros(len(queries.term), bool)
    for q, (a, b) in enumerate(zip(queries.first[:-1], queries.first[1:])):
        reach = queries.times[a:b] * largest[queries.term[a:b]]
        order = np.argsort(reach, kind="stable")
        used[a + order] = np.cumsum(reach[order]) >= least[q]

    def pick(bounds, border, refs):
        for rows, query, bound in bounds:
            value, _ = _lists(refs, border, rows[bound >= least[query]])
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(np.full(len(value), query, np.int32))], names=["ref", "query"])

    rows, shared = _chosen(cut, queries, used, "ref long, query int", pick)
    kept = written(rows.groupBy("ref").agg(F.collect_set("query").alias("queries")), "candidates")
    shared.destroy()
    return kept


def scored(found: DataFrame, vectors: DataFrame, queries: Queries, rank: Ranking) -> DataFrame:
    """(query, ref, doc_id, score) of ``found`` (ref, queries), exactly; scores above 0; written, the best of each query."""
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast((queries, rank))

    def run(batches):
        queries, rank = shared.value
        weights = np.zeros(len(queries.terms), np.int64)
        for batch in batches:
            border, term, impact = _impacts(batch, rank)
            at, wanted = _flat(batch.column("queries"))
            order = np.argsort(wanted, kind="stable")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))[order]
            for q in np.unique(wanted).tolist():
                mine = slice(queries.first[q], queries.first[q + 1])
                weights[queries.term[mine]] = queries.times[mine]
                docs = doc[np.searchsorted(wanted, q, "left", order) : np.searchsorted(wanted, q, "right", order)]
                for a, b in W.slices(np.r_[0, np.cumsum(np.diff(border)[docs])]):
                    t, count = _lists(term, border, docs[a:b])
                    x, _ = _lists(impact, border, docs[a:b])
                    sums, ends = np.r_[0, np.cumsum(x * weights[t])], np.cumsum(count)
                    score = sums[ends] - sums[ends - count]
                    keep = score > 0
                    these = pa.array(docs[a:b][keep])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(these), q, np.int32)), batch.column("ref").take(these),
                                                      batch.column("doc_id").take(these), pa.array(score[keep])], names=["query", "ref", "doc_id", "score"])
                weights[queries.term[mine]] = 0

    rows = vectors.join(found, "ref").select("ref", "doc_id", "n", "terms", "tfs", "queries").mapInArrow(
        run, "query int, ref long, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "ref")
    kept = written(rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST), "scored")
    shared.destroy()
    return kept


def _group(docs: DataFrame, queries: Queries) -> DataFrame:
    """(query, rank, doc_id, score) of one group of queries."""
    vectors = forward(docs, queries)
    rank = ranking(vectors, len(queries.terms))
    cut = blocks(vectors, queries, rank)
    first = seeds(cut, queries)
    keyed = vectors.withColumn("key", F.xxhash64("ref"))
    near, _ = parted(keyed, first.select(F.xxhash64("ref").alias("key")))
    best = scored(first.groupBy("ref").agg(F.collect_set("query").alias("queries")), near.drop("key"), queries, rank)
    least = np.ones(len(queries.ids), np.int64)
    for r in best.where(F.col("rank") == BEST).select("query", "score").collect():
        least[r["query"]] = r["score"]
    found = scored(candidates(cut, queries, least), vectors, queries, rank)
    ids = found.sparkSession.createDataFrame(pa.table({"query": pa.array(np.arange(len(queries.ids)), pa.int32()), "item": queries.ids}))
    return found.join(ids, "query").select("item", "rank", "doc_id", "score")


def grouped(items: DataFrame, shape: Shape = Shape()) -> tuple[DataFrame, list[Queries]]:
    """(item, item_id) of all rows of ``items``, numbered when written, and the groups of those that have words."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id"), word_list(F.col("text")).alias("words"))
    rows = written(rows, "items")
    counts = written(rows.select(F.col("item").alias("query"), F.explode("words").alias("term")).groupBy("query", "term").agg(
        F.count(F.lit(1)).alias("times")), "terms")
    size = counts.agg(F.count(F.lit(1)).alias("terms"), F.count_distinct("query").alias("queries")).first()
    groups = max(-(-size["terms"] // shape.terms), -(-size["queries"] // shape.queries))
    dealt = counts.withColumn("g", F.pmod(F.xxhash64("query"), F.lit(max(groups, 1))))
    found = [dealt.where(F.col("g") == g).drop("g").toArrow() for g in range(groups)]
    return rows.select("item", "item_id"), [queries_of(x, shape) for x in found if x.num_rows]


def search(docs: DataFrame, items: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """item_id, rank, doc_id, score: the ``BEST`` documents of each row of ``items``, scores above 0.

    Equal scores go by doc_id, a null one last.  Null and empty texts have no terms: such
    documents are found by nothing and count for nothing, such items find nothing.  Each
    row of either table stands for itself, so repeated documents are ranked one after the
    other, and an item that is there twice is answered twice.  Other columns are left aside.
    """
    numbered, groups = grouped(items, shape)
    schema = "item long, rank int, doc_id long, score long"
    found = numbered.sparkSession.createDataFrame([], schema)
    for queries in groups:
        found = found.unionByName(_group(docs, queries))
    return numbered.join(found, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_words FROM d WHERE len(ws) > 0),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, n, term, count(*) AS tf
      FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
i AS (SELECT doc_id, term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_words)))) AS impact
      FROM p JOIN df USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
