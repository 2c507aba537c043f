from __future__ import annotations

import random

import pytest

from ledgersieve.llm import sentences, suffixes
from ledgersieve.llm.spans import cut
from llm_helpers import by_id, words


def corpus():
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghij", k=5))
    run = lambda n: [word() for _ in range(n)]
    passages = [run(n) for n in (50, 51, 60, 90, 200, 55)]
    docs = []
    for n in range(30):
        text = run(draw.randint(0, 40))
        for p in draw.sample(passages, n % 3):
            text += p + run(draw.randint(0, 30))
        docs.append((n, " ".join(text)))
    docs += [(40, docs[5][1]), (41, docs[5][1].upper()), (42, " ".join(passages[3] * 3)), (43, " ".join(run(20)))]
    return docs


def covered(docs, size):
    """Words of all windows of ``size`` words that come earlier, by brute force."""
    first, out = set(), {i: set() for i, _ in docs}
    for i, t in sorted(docs):
        w = words(t)
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            if key in first:
                out[i].update(range(p, p + size))
            first.add(key)
    return out


def found_words(rows):
    return {i: {x for s in r["spans"] for x in range(s["start"], s["end"])} for i, r in rows.items()}


def test_every_passage_of_fifty_words_is_found_and_nothing_else(docs_of):
    docs = corpus()
    found = found_words(by_id(suffixes.repeated_passages(docs_of(docs))))
    for i, need in covered(docs, 50).items():
        assert need <= found.get(i, set())
    may = covered(docs, suffixes.PREFIX)
    for i, have in found.items():
        assert have <= may[i]


def test_large_groups_are_dealt_to_several_tasks(docs_of, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_ROWS", 3)
    docs = corpus()
    found = found_words(by_id(suffixes.repeated_passages(docs_of(docs))))
    may = covered(docs, suffixes.PREFIX)
    assert {i for i, need in covered(docs, 50).items() if need} <= set(found)
    assert all(suffixes.PREFIX <= len(have) and have <= may[i] for i, have in found.items())


def test_sentence_runs(docs_of):
    line = "One two three four five six. Seven eight nine ten eleven twelve! Thirteen fourteen fifteen sixteen? "
    docs = [(1, line + "Alone here and quite new it is."), (2, "Before. " + line), (3, "One two three four five six. Something else."),
            (4, "Yes. No. Yes. No. Yes. No."), (5, line + line)]
    found = by_id(sentences.repeated_sentences(docs_of(docs)))
    assert set(found) == {2, 5}
    assert found[2]["first_docs"] == [1] and found[5]["n_repeated"] >= 30
    texts = by_id(cut(docs_of(docs), sentences.repeated_sentences(docs_of(docs))))
    assert texts[1]["text"] == docs[0][1] and texts[2]["text"].startswith("Before.") and "eleven" not in texts[2]["text"]


def test_a_passage_inside_other_sentences_is_found(docs_of):
    draw = random.Random(3)
    run = lambda n: " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))
    passage = run(80)
    docs = [(n, f"{run(13 + n)} {passage} {run(9)}.") for n in range(20)]
    found = by_id(sentences.repeated_sentences(docs_of(docs)))
    assert set(found) == set(range(1, 20)) and all(r["n_repeated"] > 40 for r in found.values())


def test_every_unpunctuated_passage_of_51_words_is_found(docs_of):
    draw = random.Random(11)
    run = lambda n: ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]
    docs = []
    for n in range(300):
        passage = run(51)
        docs += [(2 * n, " ".join(run(3 + n % 17) + passage + run(n % 23))), (2 * n + 1, " ".join(run(1 + n % 19) + passage + run(n % 13)))]
    need = {i for i, at in covered(docs, 50).items() if at}
    assert need == set(range(1, 600, 2))
    found = found_words(by_id(sentences.repeated_sentences(docs_of(docs))))
    assert need == set(found)
    may = covered(docs, sentences.LEAST_WORDS)
    assert all(have <= may[i] for i, have in found.items())


@pytest.mark.parametrize("operator", [suffixes.repeated_passages, sentences.repeated_sentences])
def test_odd_rows(operator, odd, none, docs_of):
    found = by_id(operator(odd))
    assert not set(found) & {None, 1, 2, 3, 4, 5, 6}
    assert found[9]["n_repeated"] > 4500 and 7 not in found
    assert operator(none).count() == 0
    assert cut(odd, operator(odd)).count() == odd.count()
