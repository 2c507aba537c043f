from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa

from ledgersieve.llm import minhash, words as W
from ledgersieve.llm.components import components
from llm_helpers import words


def classes(texts, threshold=0.8):
    """Connected components of all pairs of five-word shingle sets, by brute force."""
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and both / len(sets[a] | sets[b]) >= threshold:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def corpus(seed=5):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghij", k=4))
    texts = []
    for group, size in enumerate((12, 6, 4, 1, 1, 1)):
        base = [word() for _ in range(120)]
        for n in range(size):
            text = list(base)
            for _ in range(n % 4):
                text[draw.randrange(len(text))] = word()
            texts.append((100 * group + n, " ".join(text)))
    # A chain: neighbours are alike, its ends are not.
    base = [word() for _ in range(150)]
    for n in range(6):
        texts.append((900 + n, " ".join(base[4 * n : 4 * n + 110])))
    return texts


def test_classes_equal_brute_force(docs_of):
    texts = corpus()
    found = minhash.near_duplicates(docs_of(texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == classes(texts)


def test_one_row_of_a_class_is_kept(docs_of):
    found = minhash.near_duplicates(docs_of(corpus())).collect()
    kept = [r["class_id"] for r in found if r["keep"]]
    assert sorted(kept) == sorted({r["class_id"] for r in found})
    assert minhash.kept(docs_of(corpus())).count() == len(kept)


def test_signatures_agree_as_often_as_the_probability_jaccard_says():
    draw = np.random.default_rng(1)
    shingles = W.mix(draw.integers(0, 1 << 62, 60).astype(np.uint64))
    x, y = draw.uniform(0.5, 4, 60), draw.uniform(0.5, 4, 60)
    x[:15] = 0
    y[45:] = 0
    both = [i for i in range(60) if x[i] and y[i]]
    expected = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(60)) for i in both)
    m = 6000
    sign = [minhash.signatures(np.zeros((w > 0).sum(), int), shingles[w > 0], w[w > 0], 1, m)[0] for w in (x, y)]
    assert abs((sign[0] == sign[1]).mean() - expected) < 0.03


def test_odd_rows(odd, none):
    found = minhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["class_id"] == 1 and by[1][0]["class_size"] == 1 and by[2][0]["keep"]
    assert {r["class_id"] for r in by[7]} == {7} and by[8][0]["class_id"] == 7 and not by[8][0]["keep"]
    assert {r["class_id"] for r in by[None]} == {None, 7}
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.kept(odd).columns == odd.columns


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 130)} == {100}


def test_unequal_repeats_hide_no_pair(docs_of):
    """Plain similarity 0.84; one text repeats a third of the other's words thirty times."""
    draw = random.Random(7)
    run = lambda n: ["".join(draw.choices("abcdefghij", k=5)) for _ in range(n)]
    texts = []
    for n in range(200):
        text = run(200)
        rest = list(text[67:])
        for at in (20, 60, 100):
            rest[at] = run(1)[0]
        texts += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(text[:67] * 30 + rest))]
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs_of(texts)).collect()}
    assert found == {i: i - i % 2 for i, _ in texts}
