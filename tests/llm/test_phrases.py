from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from ledgersieve.llm import phrases as P
from llm_helpers import LOWER


def plain(rows, best=2000, least=10):
    f, n = {}, Counter()
    for lang, text in rows:
        count = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for m in (1, 2, 3):
                count.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        found = []
        frequent = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        covered = {}
        for p, c in frequent.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    covered[q] = max(covered.get(q, 0), c)
        for p, a in frequent.items():
            if 100 * covered.get(p, 0) >= 50 * a:
                continue
            cuts = [(int(Fraction(10**6 * a * a, count[p[:k]] * count[p[k:]])), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, r, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for r, x in enumerate(sorted(found)[:best], 1)]
    return sorted(out)


def frame(spark, rows):
    """Clashing names beside the text."""
    return spark.createDataFrame([(i, t, g, 0, "x", 0.5, 7) for i, (g, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string, total double, shard int")


def listed(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts_of(draw, n, size):
    vocabulary = [f"W{k}é" if k % 7 == 0 else f"w{k}" for k in range(size)]
    weights = [1 / (k + 1) for k in range(size)]
    sign = lambda: draw.choices(["", ".", ",", "\n", ";!", "\t"], [12, 1, 1, 1, 1, 1])[0]
    return [(draw.choice(["en", "en", "de", None]), " ".join(w + sign() for w in draw.choices(vocabulary, weights, k=draw.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("shards", [1, 2, 4])
def test_random_texts_equal_brute_force(spark, shards):
    draw = random.Random(shards)
    rows = texts_of(draw, 250, 60) + [("en", "New york city is Far. new YORK city")] * 12 + [("fr", "a b c " * 9), ("fr", "c a b")]
    found = listed(P.collocations(frame(spark, rows), shards=shards))
    assert found == plain(rows)
    assert len(found) > 50


def test_phrases_that_reach_the_threshold_late_are_whole(spark):
    """Each phrase stands in few texts, so that its parts reach the threshold in different scans."""
    draw = random.Random(1)
    rows = []
    for k in range(60):
        rows += [("en", f"x{k} y{k} z{k}")] * draw.randint(8, 13) + [("en", f"y{k} z{k}. x{k}, y{k}\tu{k % 3}")] * draw.randint(0, 9)
    rows = [(g, t + " " * i) for i, (g, t) in enumerate(rows)]  # other texts, so other shards
    for shards in (3, 4):
        assert listed(P.collocations(frame(spark, rows), shards=shards)) == plain(rows)


def test_shared_buckets_change_nothing(spark):
    """Eight buckets: nearly all is active in every scan, and nothing is counted twice."""
    rows = texts_of(random.Random(9), 120, 40)
    rows = frame(spark, [(g, f"{t} tail{i % 9} end{i % 9}") for i, (g, t) in enumerate(rows)])
    few, many = (sorted(map(tuple, P.counts(rows, shards=3, bits=bits).collect())) for bits in (3, P.BUCKET_BITS))
    assert few == many and len(few) > 50


def test_limit_and_ties(spark):
    rows = [("en", " ".join(f"p{k:02d} q{k:02d}." for k in range(30)))] * 10
    found = listed(P.collocations(frame(spark, rows), best=7))
    assert found == plain(rows, best=7)
    assert [r[2] for r in found] == [f"p{k:02d} q{k:02d}" for k in range(7)]


def test_products_beyond_64_bits(spark):
    every = spark.createDataFrame([("en", 0, "", 10**14), ("en", 1, "a", 9 * 10**13), ("en", 1, "b", 8 * 10**13), ("en", 2, "a b", 7 * 10**13)],
                                  "lang string, n int, phrase string, total long")
    r = P.candidates(every).first()
    assert r["score"] == 10**6 * (7 * 10**13) ** 2 // (9 * 10**13 * 8 * 10**13)


def test_odd_rows(spark, odd, none):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert listed(P.collocations(odd)) == plain(rows)
    assert P.collocations(none).count() == 0
    assert P.collocations(frame(spark, [(None, None), ("en", "")])).count() == 0
