from __future__ import annotations

import random
import tracemalloc

import corpus_pipeline
import numpy as np

from ledgersieve.llm import toxicity as X


def corpus(spark, docs_of, n=900):
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    docs, labels = [], []
    for i in range(n):
        text, bad = [word() for _ in range(draw.randint(5, 60))], i % 5 == 0
        if bad:
            text[draw.randrange(len(text))] = draw.choice(["Vile", "rotten", "nasty"])
        docs.append((i, " ".join(text)))
        labels.append((i, int(bad), 1))
    return docs_of(docs), spark.createDataFrame(labels, "doc_id long, toxic int, score int"), dict((i, t) for i, t, _ in labels)


def test_held_out_documents(spark, docs_of):
    docs, labels, truth = corpus(spark, docs_of)
    found = X.toxicity(docs, labels).collect()
    held = [r for r in found if r["held_out"]]
    right = [r["predicted"] == truth[r["doc_id"]] for r in held]
    assert len(held) > 100 and np.mean(right) > 0.95
    clean = [r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert np.mean(clean) < 0.02


def test_labels_of_held_out_documents_change_nothing(spark, docs_of):
    docs, labels, _ = corpus(spark, docs_of, 300)
    turned = labels.withColumn("toxic", X.F.when(X.fold() == 0, 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    score = lambda y: {r["doc_id"]: r["score"] for r in X.toxicity(docs, y).collect()}
    assert score(labels) == score(turned)


def test_odd_rows(spark, odd, none, docs_of):
    labels = spark.createDataFrame([(7, 1), (7, 0), (5, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    found = X.toxicity(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2, 3)}) == 1
    assert X.toxicity(none, labels).count() == 0
    assert {r["score"] for r in X.toxicity(odd, labels.where("doc_id = 100")).collect()} == {0.0}
    kept = X.kept(odd, X.model(odd, labels))
    assert kept.columns == odd.columns


def test_nothing_learnt_drops_nothing(spark, docs_of, tmp_path):
    docs, labels, _ = corpus(spark, docs_of, 40)
    usable = labels.where(X.fold() != 0)
    cases = {
        "empty": labels.limit(0), "null": labels.withColumn("toxic", X.F.lit(None).cast("int")),
        "strange": labels.withColumn("doc_id", X.F.col("doc_id") + 1000), "held_out": labels.where(X.fold() == 0),
        "one": usable.limit(1).withColumn("toxic", X.F.lit(1)),
    }
    for name, some in cases.items():
        folder = str(tmp_path / name)
        some.write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.drop_toxic(spark, docs, folder).count() == docs.count(), name
        assert {(r["score"], r["predicted"]) for r in X.toxicity(docs, some).collect()} == {(0.0, 0)}, name


def plain_ftrl(rows, epochs):
    """The rule over dictionaries, one coordinate after another."""
    z, n = {}, {}

    def weight(i):
        least = 0.0 if i == X.BIAS else X.L1
        zi = z.get(i, 0.0)
        if abs(zi) <= least:
            return 0.0
        return -(zi - (least if zi > 0 else -least)) / ((X.BETA + n.get(i, 0.0) ** 0.5) / X.ALPHA + X.L2)

    for _ in range(epochs):
        for places, label in rows:
            w = {i: weight(i) for i in places}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i in places:
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / X.ALPHA * w[i]
    return {i: weight(i) for i in z if weight(i)}


def test_weights_equal_a_plain_rule():
    draw = random.Random(4)
    rows = []
    for _ in range(400):
        label = int(draw.random() < 0.3)
        places = {X.BIAS, *draw.choices(range(1, 300), k=12)} | ({7, 9} if label else {11})
        rows.append((np.array(sorted(places), np.int32), label))
    learnt = X.ftrl(rows, 3)
    expected = plain_ftrl([(p.tolist(), y) for p, y in rows], 3)
    assert set(learnt.place.tolist()) == set(expected) and len(expected) > 3
    assert np.allclose(learnt.value, [expected[i] for i in learnt.place.tolist()], rtol=1e-3)


def test_predicted_is_the_score_alone(spark, docs_of):
    """Toxic labels only: whatever is learnt, ``predicted`` is ``score >= 0.5``."""
    docs, labels, _ = corpus(spark, docs_of, 40)
    found = X.toxicity(docs, labels.withColumn("toxic", X.F.lit(1))).collect()
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in found)


def test_the_bias_has_no_penalty():
    learnt = X.ftrl([(np.array([X.BIAS, n + 1]), 0) for n in range(3)], epochs=1)
    assert list(learnt.place) == [X.BIAS] and learnt.value[0] < 0 and not X.learnt(learnt)


def test_shards_are_learnt_apart_wherever_they_meet(spark, docs_of, monkeypatch):
    """Several shards, in one task or in many, give the mean of their weights."""
    docs, labels, _ = corpus(spark, docs_of, 300)
    monkeypatch.setattr(X, "SHARD_ROWS", 60)
    labelled = X.sample(labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = labelled.collect()
    shards = -(-len(rows) // 60)
    assert shards >= 4
    expected, groups = {}, {}
    for r in labelled.withColumn("s", X.F.pmod(X.F.xxhash64("h", X.F.lit(1)), X.F.lit(shards))).orderBy("h").collect():
        groups.setdefault(r["s"], []).append(r)
    for group in groups.values():
        held = X.Rows()
        for r in group:
            for _, _, words in X.W.each_slice(X.pa.array([texts[r["doc_id"]]])):
                place, border = X.features(words)
                held.add(place, border, np.array([r["label"]]))
        learnt = X.ftrl(held)
        for i, v in zip(learnt.place.tolist(), learnt.value.tolist()):
            expected[i] = expected.get(i, 0.0) + v / shards
    found = {r["place"]: r["weight"] for r in X.train(docs, labelled).collect()}
    assert set(found) == set(expected) and np.allclose([found[i] for i in expected], list(expected.values()), atol=1e-5)


def peak_mb(run):
    """What ``run`` gives, and the most memory it held."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_scoring_and_learning_hold_little():
    """Scores need no number per coordinate, learning the two of its rule and no more copies of them."""
    texts = X.pa.array([None, ""] + [f"some words {i} and {i * 7} more of them" for i in range(300)])
    places = X.features(next(X.W.each_slice(texts))[2])[0]
    some = np.unique(np.r_[X.BIAS, places[::3], X.BIAS + 5]).astype(np.int64)
    weights = X.Weights(some, np.random.default_rng(2).normal(size=len(some)))
    X.W.powers(X.W._BASE, 1), X.W.powers(X.W._BASE_INVERSE, 1)
    found, held = peak_mb(lambda: X._scores(weights)(texts))
    assert held < 20
    of = dict(zip(some.tolist(), weights.value.astype(np.float32).tolist()))
    for i, text in enumerate(texts.to_pylist()):
        own = X.features(next(X.W.each_slice(X.pa.array([text], X.pa.string())))[2])[0]
        total = of[X.BIAS] + sum(of.get(p, 0.0) for p in own.tolist())
        assert abs(found[i] - 1 / (1 + np.exp(-total))) < 1e-6
    rows = [(np.array([X.BIAS, 3], np.int32), 1)]
    assert peak_mb(lambda: X.ftrl(rows, 1))[1] < 175
