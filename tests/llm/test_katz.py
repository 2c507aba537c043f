from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgersieve.llm import katz
from llm_helpers import LOWER, by_id


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["\n"]


class Plain:
    """The model of the module's docstring over dictionaries."""

    def __init__(self, texts, size):
        learn = [tokens(t) for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
        self.c = Counter(w for t in learn for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        ranked = sorted((w for w in self.c if w != "\n"), key=lambda w: -self.c[w])[: size - 2]
        if len(ranked) < self.v - 1:
            assert self.c[ranked[-1]] > max(self.c[w] for w in self.c if w != "\n" and w not in set(ranked)), "a tie at the border"
        self.top = set(ranked) | {"\n"}
        times = Counter(self.c.values())
        self.d1 = katz.discounts(np.array([0] + [times[r] for r in range(1, 7)]))
        self.new = sum((1 - self.d1[r]) * r * times[r] for r in range(1, 6)) / self.n
        self.p = {w: self.single(w) for w in self.top}
        self.p[None] = 1 - sum(self.p.values())
        self.pairs = Counter((a, b) for t in learn for a, b in zip(map(self.cls, ["\n", *t]), map(self.cls, t)))
        times = Counter(self.pairs.values())
        self.d = katz.discounts(np.array([0] + [times[r] for r in range(1, 7)]))
        self.whole, self.mass, self.low, cut = Counter(), Counter(), Counter(), set()
        for (a, b), c in self.pairs.items():
            self.whole[a] += c
            self.mass[a] += c * (self.d[c] if c <= 5 else 1)
            self.low[a] += self.p[b]
            cut |= {a} if c <= 5 else set()
        for a in self.whole:
            self.whole[a] = self.mass[a] if 1 - self.low[a] < 1e-12 else self.whole[a] + (a not in cut)

    def cls(self, w):
        return w if w in self.top else None

    def single(self, w):
        return (self.d1[self.c[w]] if self.c[w] <= 5 else 1) * self.c[w] / self.n if self.c[w] else self.new

    def pair(self, a, b):
        c = self.pairs.get((a, b), 0)
        if c:
            return c * (self.d[c] if c <= 5 else 1) / self.whole[a]
        if self.whole[a] and 1 - self.low[a] < 1e-12:
            return 0
        return (1 - self.mass[a] / self.whole[a]) / (1 - self.low[a]) * self.p[b] if self.whole[a] else self.p[b]

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.pair(self.cls(a), self.cls(b)) * (1 if self.cls(b) else self.single(b) / self.p[None]))
                   for a, b in zip(["\n", *t], t))


def corpus():
    draw = random.Random(4)
    vocabulary = [f"W{i}" for i in range(60)]
    weight = [1 / (i + 1) for i in range(60)]
    return [(n, " ".join(draw.choices(vocabulary, weight, k=draw.randint(0, 60)) + [f"rare{n}"] * (n % 3))) for n in range(80)]


@pytest.mark.parametrize("size", [katz.VOCABULARY, 9])
def test_scores_equal_the_plain_model(docs_of, size):
    texts = corpus()
    model, found = Plain(texts, size), by_id(katz.lm_scores(docs_of(texts), size))
    for i, t in texts:
        r, w = found[i], tokens(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in model.c for x in w), model.n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(sum(math.log10((model.c[x] + 1) / (model.n + model.v + 1)) for x in w), rel=1e-9)
        assert r["score"] == pytest.approx(model.score(t), rel=1e-9)
    for a in [*model.top, None]:
        assert sum(model.pair(a, b) for b in model.p) == pytest.approx(1)


def test_words_outside_the_broadcast_table_have_pair_counts_of_their_own(docs_of):
    texts = corpus() + [(100 + n, f"twin{n % 4} other{n % 4} W1") for n in range(20)]
    model = Plain(texts, katz.VOCABULARY)
    for held in (4, 9, katz.VOCABULARY):
        found = by_id(katz.lm_scores(docs_of(texts), held=held))
        for i, t in texts:
            assert found[i]["score"] == pytest.approx(model.score(t), rel=1e-9)
            assert found[i]["n_known"] == sum(x in model.c for x in tokens(t))
            assert found[i]["base_score"] == pytest.approx(sum(math.log10((model.c[x] + 1) / (model.n + model.v + 1)) for x in tokens(t)), rel=1e-9)


def test_odd_rows(odd, none, docs_of):
    found = katz.lm_scores(odd).collect()
    assert len(found) == odd.count()
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in found)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (1, 2, 3)} == {1}
    assert len({r["score"] for r in found if r["doc_id"] == 7}) == 1
    assert katz.lm_scores(none).count() == 0
    assert all(math.isfinite(r["score"]) for r in katz.lm_scores(docs_of([(1, "a"), (2, "b c")])).collect())


def test_scores_do_not_depend_on_the_files(spark, tmp_path):
    """The same documents twice, in one partition and in two files of equal content."""
    rows = [(i, " ".join(f"w{(i * j) % 11}" for j in range(i % 7 + 3))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for name in ("a", "b"):
        frame.write.parquet(str(tmp_path / name))
    parted = spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b"))
    whole = spark.createDataFrame(rows * 2, "doc_id long, text string").coalesce(1)
    listed = lambda df: sorted((r["doc_id"], round(r["score"], 9), round(r["base_score"], 9)) for r in katz.lm_scores(df).collect())
    assert listed(parted.repartition(1)) == listed(whole)
    assert listed(parted) == listed(whole)
