from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgersieve.llm import bpe
from llm_helpers import by_id

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def plain(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    back = TOKENIZER.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize("head", [0, 5, bpe.HEAD_WORDS])
def test_same_as_the_library(docs_of, head):
    draw = random.Random(1)
    signs = ["the", " the", "é", "日本", " ", "  ", "\n", "'s", "'", "12", "<|endoftext|>", "😀", "!", " ", "ＡＢ"]
    texts = [(n, "".join(draw.choices(signs, k=draw.randint(0, 40)))) for n in range(150)]
    found = by_id(bpe.encode_decode(docs_of(texts), PATH, head_words=head))
    assert {i: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for i, r in found.items()} == {i: plain(t) for i, t in texts}


def test_ids_and_texts(docs_of):
    found = by_id(bpe.encode_decode(docs_of([(1, "Hello  wörld"), (2, None)]), PATH, digests=False))
    assert found[1]["decoded"] == "Hello  wörld" and found[1]["ids"] == TOKENIZER.encode("Hello  wörld").ids and found[2]["ids"] == []


def test_odd_rows(odd, none):
    found = bpe.encode_decode(odd, PATH).collect()
    assert len(found) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    for r in found:
        if r["doc_id"] is not None:
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == plain(texts[r["doc_id"]])
    assert bpe.encode_decode(none, PATH).count() == 0


def test_long_words_of_one_pattern_are_told_apart(docs_of):
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    texts = [(1, one), (2, other), (3, f"{one} {other}")]
    found = by_id(bpe.encode_decode(docs_of(texts), PATH, head_words=0))
    assert {i: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for i, r in found.items()} == {i: plain(t) for i, t in texts}


def test_blocks_get_the_ids_of_their_words_without_a_join(docs_of):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghé ", k=draw.randint(1, 9))) for _ in range(3000)]
    texts = [(n, " ".join(draw.choices(words, k=1500))) for n in range(600)]
    coded = bpe.encode_decode(docs_of(texts).repartition(2, "doc_id"), PATH)
    found = by_id(coded)
    assert {i: (found[i]["n_tokens"], found[i]["ids_sha256"], found[i]["decoded_sha256"]) for i, _ in texts} == {i: plain(t) for i, t in texts}
    assert "Join" not in coded._jdf.queryExecution().toString()
