"""The vectorised splitting rule against the tokenizers library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgersieve.llm import bpe, words as W

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = b"<|endoftext|>"


def pieces(texts):
    raw, offsets = W.text_bytes(pa.array(texts, pa.string()))
    start, end, first = bpe.split(raw, offsets, bpe._classes(PATH), (SPECIAL,))
    return [[raw[a:b].tobytes() for a, b in zip(start[i:j], end[i:j])] for i, j in zip(first[:-1], first[1:])]


TOKENIZER = Tokenizer.from_file(PATH)


def library(text):
    tok = TOKENIZER
    out, rest = [], text.split(SPECIAL.decode())
    for n, part in enumerate(rest):
        if n:
            out.append(SPECIAL)
        out += [part[a:b].encode() for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(part)]
    return out


CASES = ["", " ", "  ", "\n", " \n a", "a  b", "a   b", "a\n\nb", "a \n", "it's 'tis 's's ''re've'll'd'm'l 'r", "!'s '' ''s x''s",
         "a b  b", "　　x", "x  y", "don't  'll", "12ab 34'56", " 's", "  's", "a 's", "日本 語'sあ", "é'è'sé",
         "😀😀 a😀", "<|endoftext|>", "a <|endoftext|> b", " <|endoftext|><|endoftext|>\n", "x  <|endoftext|>  y", "\x85\x1c\x1d a",
         "ǅ²¾ Ⅷ", "\t\tx\t y", "'", "''", " '", "'s", "'re", "'r"]


@pytest.mark.parametrize("text", CASES)
def test_one_text(text):
    assert pieces([text])[0] == library(text)


def test_many_texts_at_once():
    draw = random.Random(3)
    signs = list("ab1 '\n\t.!’é日   srtmdlve") + ["'s", "'re", "  ", "😀", "<|endoftext|>", "<|end"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(3000)]
    assert pieces(texts) == [library(t) for t in texts]


def test_every_code_point_has_the_library_s_class():
    tok = Tokenizer.from_file(PATH)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 4096):
        text = "a".join("1" + chr(c) for c in points[low : low + 4096])  # classes join or part differently
        bounds = np.array([a for _, (a, _) in tok.pre_tokenizer.pre_tokenize_str(text)])
        raw, offsets = W.text_bytes(pa.array([text]))
        start, _, _ = bpe.split(raw, offsets, bpe._classes(PATH))
        lead = np.cumsum((raw & 0xC0) != 0x80) - 1
        assert np.array_equal(lead[start], bounds)
