from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgersieve.llm.store import ship  # noqa: E402

#: Rows that every operator over documents has to bear: nulls, empty and odd texts, a
#: long text, ties, repeated rows.
ODD_TEXTS = [
    (None, None), (1, None), (2, ""), (3, "   \n\t "), (4, "..."), (5, "one"), (6, "Ünïcode 日本語 😀 text"),
    (7, "a b c d e f g h i j k l"), (7, "a b c d e f g h i j k l"), (8, "A B C D E F G H I J K L"),
    (None, "a b c d e f g h i j k l"), (9, "word " * 5000), (10, "x" * 20000), (11, "1 2 3 " * 300), (12, "<|endoftext|> it's\x00 null"),
]
SCHEMA = "doc_id long, text string, lang string, key long, k string, node string, score double, n_chars long"


def rows(pairs):
    return [(i, t, "en", 1, "clash", "clash", 0.5, None if t is None else len(t)) for i, t in pairs]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with further columns whose names clash with the operators' own."""
    ship(spark)
    return lambda pairs: spark.createDataFrame(rows(pairs), SCHEMA)


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD_TEXTS)


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])

