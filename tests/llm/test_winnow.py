from __future__ import annotations

import hashlib
import random

from ledgersieve.llm import winnow
from llm_helpers import by_id, words


def plain(texts, items):
    wins = {}
    for item, t in items:
        w = words(t)
        for s in range(max(len(w) - 9, 1) if w else 0):
            wins.setdefault(tuple(w[s : s + 10]), set()).add(str(item if item is not None else ""))
    sizes = {len(k) for k in wins}
    out = {}
    for i, t in texts:
        w, hit, ids = words(t), set(), set()
        for m in sizes:
            for s in range(len(w) - m + 1):
                if found := wins.get(tuple(w[s : s + m])):
                    hit.update(range(s, s + m))
                    ids |= found
        out[i] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def compare(spark, docs_of, texts, items):
    found = by_id(winnow.contamination(docs_of(texts), spark.createDataFrame(items, "item_id long, text string, key string")))
    expected = plain(texts, [(i, t) for i, t, _ in items])
    assert {i: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for i, r in found.items()} == expected


def test_random_texts_of_few_words_equal_brute_force(spark, docs_of):
    """Few different words: many ties, overlaps and repeated windows."""
    draw = random.Random(2)
    text = lambda n: " ".join(draw.choices(["a", "b", "C", "é"], weights=[6, 2, 1, 1], k=n))
    items = [(n, text(draw.choice([1, 3, 9, 10, 11, 25])), "x") for n in range(12)]
    texts = [(n, text(draw.randint(0, 60))) for n in range(40)]
    texts += [(100 + n, f"{text(5)}, {items[n][1]}. {text(5)}") for n in range(12)]
    compare(spark, docs_of, texts, items)


def test_no_window_is_missed_wherever_it_stands(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(10))
    texts = [(n, " ".join([*(f"p{n}{i}" for i in range(n)), item.upper(), *(f"q{i}" for i in range(30 - n))])) for n in range(25)]
    texts += [(50, " ".join(f"w{i}" for i in range(9)))]
    compare(spark, docs_of, texts, [(1, item, "x")])


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (2, None), (3, ""), (None, "one")], "item_id long, text string")
    found = winnow.contamination(odd, items).collect()
    assert len(found) == odd.count()
    assert sorted((r["doc_id"] or -1, r["n_hit"]) for r in found if r["contaminated"]) == [(-1, 10), (5, 1), (7, 10), (7, 10), (8, 10)]
    assert winnow.contamination(none, items).count() == 0
    assert not any(r["contaminated"] for r in winnow.contamination(odd, items.where("item_id > 9")).collect())
    kept = winnow.kept(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 5
