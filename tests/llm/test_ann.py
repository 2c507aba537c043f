from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from ledgersieve.llm import ann
from ledgersieve.llm.hilbert import hilbert_keys
from ledgersieve.llm.store import ship


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (6, 2)])
def test_the_curve_visits_every_cell_and_moves_by_one(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(vectors, query, k=10):
    own = dict(vectors)[query]
    near = sorted({(math.sqrt(sum((a - b) ** 2 for a, b in zip(v, own))), i) for i, v in vectors if i != query and len(v) == len(own)})
    return near[:k]


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, node string, score long")


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(1500, 32)).astype(np.float32)
    rows = [(n, [float(c) for c in v]) for n, v in enumerate(x)]
    table = frame(spark, rows)
    found = {}
    for r in ann.nearest(table, table.where("vec_id % 100 = 0")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hits = 0
    for q, near in found.items():
        best = brute(rows, q)
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 11))
        assert [s for _, s, _ in near] == sorted(s for _, s, _ in near)
        hits += len({i for _, i in best} & {i for _, _, i in near})
    assert len(found) == 15 and hits >= 0.9 * 150


def test_copies_ties_and_unusable_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(n, same) for n in range(30)] + [(n, [float(n), 1.0, 0.0]) for n in range(30, 50)]
    bad = [(200, None), (300, [0.0, 0.0, 0.0]), (400, [1.0, float("nan"), 0.0]), (500, [1.0, None, 0.0]), (600, [float("inf"), 0.0, 1.0]),
           (None, same), (0, same), (700, [1.0, 2.0])]
    table = frame(spark, rows + bad)
    found = {}
    for r in ann.nearest(table, table.where("vec_id in (0, 20, 200, 300, 400, 500, 600, 700)")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {0, 20}
    assert [v for _, v, _ in sorted(found[0])] == list(range(1, 11))
    assert [v for _, v, _ in sorted(found[20])] == list(range(10)) and {s for *_, s in found[20]} == {0.0}


def test_few_and_no_candidates(spark):
    table = frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [5.0, 5.0])])
    assert [(r["vec_id"], r["rank"]) for r in ann.nearest(table, table.where("vec_id = 0")).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    empty = frame(spark, [])
    assert ann.nearest(empty, empty).count() == 0 and ann.nearest(table.limit(1), table.limit(1)).count() == 0
