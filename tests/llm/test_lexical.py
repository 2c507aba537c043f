from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgersieve.llm import lexical as L
from llm_helpers import words


def plain(texts, items, best=20):
    docs = [(i, words(t)) for i, t in texts]
    full = [w for _, w in docs if w]
    n_docs, n_words = len(full), sum(map(len, full))
    holding = Counter(t for w in full for t in set(w))
    out = []
    for item, text in items:
        found = []
        for i, w in docs:
            tf, score = Counter(w), 0
            m = 75 + 25 * len(w) * n_docs // n_words if w else 0
            for t in words(text):
                if tf[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                    score += weight * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=str)


def listed(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def texts_of(draw, n, long):
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    topic = lambda k: draw.choices(vocabulary[50 * k : 50 * k + 50], k=draw.randint(0, long))
    return [(i, " ".join(draw.choices(vocabulary, weights, k=draw.randint(0, long)) + topic(i % 8))) for i in range(n)]


@pytest.mark.parametrize("terms", [1 << 13, 60])
def test_random_texts_equal_brute_force(spark, docs_of, terms):
    """Small blocks, shared coordinates and several groups of queries, so that all ways are taken."""
    draw = random.Random(terms)
    shape = L.Shape(terms=terms, cells=1 << 14, least_block=3)
    texts = texts_of(draw, 300, 40)
    texts += [(500 + k, texts[7][1]) for k in range(40)] + [(7, texts[7][1])]
    items = [(n, " ".join(draw.choices([f"W{k}" for k in range(420)], k=draw.choice([1, 3, 12, 30])))) for n in range(15)]
    items += [(90, texts[7][1] + " w1 w1 w2"), (91, "nowhere"), (92, "w399")]
    found = L.search(docs_of(texts), spark.createDataFrame(items, "item_id long, text string"), shape)
    assert listed(found) == plain(texts, items)


def test_summaries_that_share_places_stay_bounds(spark, docs_of):
    draw = random.Random(3)
    texts = texts_of(draw, 200, 30)
    items = [(n, " ".join(draw.choices([f"w{k}" for k in range(400)], k=50))) for n in range(6)]
    found = L.search(docs_of(texts), spark.createDataFrame(items, "item_id long, text string"), L.Shape(width=16))
    assert listed(found) == plain(texts, items)


def test_bounds_hold_and_skip(spark, docs_of):
    """No document's score passes a bound of its block, and documents far from a query are never scored."""
    draw = random.Random(8)
    texts = [(i, " ".join(draw.choices([f"t{i % 10}x{k}" for k in range(30)], k=60)) + " the of") for i in range(400)]
    items = spark.createDataFrame([(1, " ".join(f"t3x{k}" for k in range(30)) + " the of")], "item_id long, text string")
    _, (queries,) = L.grouped(items, L.Shape(least_block=4))
    vectors = L.forward(docs_of(texts), queries)
    rank = L.ranking(vectors, len(queries.terms))
    cut = L.blocks(vectors, queries, rank)
    best = L.search(docs_of(texts), items, queries.shape).collect()
    least = min(r["score"] for r in best)
    tried = L.candidates(cut, queries, np.array([least]))
    assert {r["doc_id"] for r in best} <= {r["doc_id"] for r in tried.join(vectors, "ref").collect()}
    assert tried.count() <= 40
    for r in cut.collect():
        assert len(r["refs"]) >= 1 and r["top"] <= max(r["maxima"])


def test_odd_rows(spark, odd, none):
    items = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "one WORD"), (4, "x" * 20000), (5, " ".join(f"q{k}" for k in range(3000)))]
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, rank int, score string")
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert listed(L.search(odd, frame)) == plain(texts, items)
    assert L.search(none, frame).count() == 0
    assert L.search(odd, frame.where("item_id > 9")).count() == 0
