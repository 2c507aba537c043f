"""Approximate nearest neighbours on several shifted Hilbert curves.

Each curve has a random orthonormal projection to ``DIMENSIONS`` axes and a random shift
of its grid.  A vector's place on a curve is a number, so the curve is cut into ranges of
equal counts, and a query looks at the ranges around its own on every curve.  A range
meets the queries near it in one task, which measures exact distances and keeps the best
of them; the curves' results are merged and ranked.

The window is a share of the curve, not a number of rows: for vectors without clusters the
neighbours of a point are spread so far that a fixed window loses recall as rows are added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgersieve.llm.hilbert import hilbert_keys
from ledgersieve.llm.store import written

CURVES, DIMENSIONS, BITS = 14, 6, 6
#: A curve has RANGES ranges of equal counts (fewer where they would hold less than LEAST_ROWS);
#: a query sees its own and, on either side, the share REACH of them.
RANGES, LEAST_ROWS, REACH = 200, 64, 0.05
#: Rows of a range, and queries, that one task holds at most (by more splits beyond it).
TASK_ROWS = 4096
#: Vectors the grids are fitted on, chosen by a hash of vec_id; all vectors are indexed.
FIT_ROWS = 4096


def usable(vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of rows with an id and a vector that is not zero and wholly finite."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_name).cast("long").alias("vec_id"), v.alias("embedding"))
    return rows.where("vec_id is not null and embedding is not null").where(
        ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("embedding", lambda x: x != 0)).distinct()


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def grid(size: int, curve: int, seed: int):
    """Projection axes and shift of one curve."""
    draw = np.random.default_rng([seed, size, curve])
    axes = np.linalg.qr(draw.normal(size=(max(size, 1), max(size, 1))))[0][:, :DIMENSIONS]
    return axes, draw.uniform(0, 0.25, size=axes.shape[1])


def _fit(rows: DataFrame, total: int) -> dict[int, tuple[np.ndarray, float]]:
    """Center and scale for each vector length, from a bounded sample."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(min(1, FIT_ROWS / max(total, 1)) * (1 << 20))
    fitted = {}
    by_size = {}
    for x in rows.where(part).select("embedding").limit(2 * FIT_ROWS).collect():
        by_size.setdefault(len(x[0]), []).append(x[0])
    for size, xs in by_size.items():
        xs = np.array(xs)
        center = xs.mean(axis=0)
        fitted[size] = center, max(float(np.sqrt(((xs - center) ** 2).mean())), 1e-12)
    return fitted


def keys_of(x: np.ndarray, curve: int, fitted, seed: int) -> np.ndarray:
    """Places of equally long vectors on one curve."""
    center, spread = fitted.get(x.shape[1], (np.zeros(x.shape[1]), 1.0))
    axes, shift = grid(x.shape[1], curve, seed)
    cells = (((x - center) @ axes / spread) / 6 + 0.5) * 0.75 + shift
    return hilbert_keys(np.clip(cells * (1 << BITS), 0, (1 << BITS) - 1).astype(np.uint32), BITS)


def _keyed(rows: DataFrame, fitted, curves: int, seed: int) -> DataFrame:
    """(size, curve, place, vec_id, embedding): each vector on each curve."""
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                x = _matrix(part.column(1))
                for curve in range(curves):
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, size, np.int32)), pa.array(np.full(n, curve, np.int32)),
                         pa.array(keys_of(x, curve, fitted, seed)), part.column(0), part.column(1)],
                        names=["size", "curve", "place", "vec_id", "embedding"])

    return rows.select("vec_id", "embedding").mapInArrow(
        run, "size int, curve int, place long, vec_id long, embedding array<double>")


def _best(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        queries, near, far = [], [], []
        ids = left["vec_id"].to_numpy()
        if len(ids) and right.num_rows:
            x, q, names = _matrix(left["embedding"]), _matrix(right["embedding"]), right["vec_id"].to_numpy()
            for name, row in zip(names, q):
                d = ((x - row) ** 2).sum(axis=1)
                if len(d) > k:
                    edge = np.partition(d, k - 1)[k - 1]
                    at = np.flatnonzero(d <= edge)
                    at = at[np.lexsort((ids[at], d[at]))][:k]
                else:
                    at = np.arange(len(d))
                queries.append(np.full(len(at), name)), near.append(ids[at]), far.append(np.sqrt(d[at]))
        join = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.empty(0, t)
        return pa.table({"query_id": join(queries, np.int64), "node": join(near, np.int64), "score": join(far, np.float64)})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, curves: int = CURVES, reach: float = REACH,
            seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of ``vectors`` found for each of ``queries``.

    Both have vec_id and embedding.  Nearness is Euclidean distance in double precision,
    ties go to the smaller vec_id; rows with the query's own vec_id are no candidates.
    Equal vectors are indexed once and all stand for themselves in the result, so a
    vector that a third of all rows hold is one place on a curve.  Null ids, vectors that
    are null or zero, or hold null or non-finite components take no part; vectors meet
    only vectors as long as they are; repeated rows count once; fewer candidates than
    ``k`` are all returned.  Other columns are left aside.
    """
    rows = usable(vectors)
    # Only the k + 1 smallest ids of equal vectors can be among the k nearest of anything.
    alike = Window.partitionBy(F.xxhash64("embedding"), "embedding").orderBy("vec_id")
    first = written(rows.withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1), "vectors")
    nodes = first.where("n = 1").select("vec_id", "embedding")
    total, asked = nodes.count(), usable(queries)
    asked = written(asked, "queries")
    fitted = _fit(nodes, total)
    placed = written(_keyed(nodes, fitted, curves, seed), "places")
    cuts, ranges = {}, max(1, min(RANGES, total // LEAST_ROWS))
    aside = -(-int(reach * ranges * 1000) // 1000)
    steps = F.array(*(F.lit(i / ranges) for i in range(ranges)))
    for r in placed.groupBy("size", "curve").agg(F.percentile_approx("place", steps, 20_000).alias("c")).collect():
        cuts[(r["size"], r["curve"])] = np.array(r["c"][1:])

    def ranged(df: DataFrame, splits: int) -> DataFrame:
        def run(batches):
            for batch in batches:
                size, curve, place = (batch.column(i).to_numpy() for i in range(3))
                found = np.zeros(len(place), np.int32)
                for s, c in set(zip(size.tolist(), curve.tolist())):
                    these = (size == s) & (curve == c)
                    found[these] = np.searchsorted(cuts.get((s, c), np.empty(0)), place[these], "right")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found), batch.column(3), batch.column(4)],
                    names=["size", "curve", "range", "vec_id", "embedding"])

        return df.mapInArrow(run, "size int, curve int, range int, vec_id long, embedding array<double>").withColumn(
            "part", F.pmod(F.xxhash64("vec_id"), F.lit(splits)).cast("int"))

    n_asked = asked.count()
    width = (2 * aside + 1) / ranges
    splits = max(1, -(-total // (ranges * TASK_ROWS)))
    chunks = max(1, -(-int(n_asked * width) // TASK_ROWS))
    blocks = ranged(placed, splits).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    wanted = ranged(_keyed(asked, fitted, curves, seed), chunks).withColumnRenamed("part", "chunk")
    wanted = wanted.withColumn("range", F.explode(F.sequence(
        F.greatest(F.col("range") - aside, F.lit(0)), F.least(F.col("range") + aside, F.lit(ranges - 1)))))
    wanted = wanted.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    key = ["size", "curve", "range", "part", "chunk"]
    found = blocks.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(
        _best(k + 1), "query_id long, node long, score double")
    found = found.groupBy("query_id", "node").agg(F.min("score").alias("score"))
    near = Window.partitionBy("query_id").orderBy("score", "node")
    found = found.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1).select("query_id", "node", "score")
    copies = first.select(F.col("vec_id"), F.xxhash64("embedding").alias("h"), "embedding")
    owner = nodes.select(F.col("vec_id").alias("node"), F.xxhash64("embedding").alias("h2"), F.col("embedding").alias("e2"))
    members = copies.join(owner, (F.col("h") == F.col("h2")) & (F.col("embedding") == F.col("e2"))).select("node", "vec_id")
    every = found.join(members, "node").where("vec_id <> query_id")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return every.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
