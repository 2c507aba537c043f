from __future__ import annotations

import numpy as np
import psutil

from ledgersieve.llm.store import lean


def resident() -> float:
    return psutil.Process().memory_info().rss / 1e6


def test_a_task_gives_its_memory_back():
    left = []

    def run(batches):
        parts = [np.ones(100_000, np.uint8) for _ in range(3_000)]
        left.append(np.ones(100_000, np.uint8))  # lies behind the others, so that they don't end the heap
        yield from batches
        del parts

    before = resident()
    found, most = [], 0.0
    for x in lean(run)(iter("abc")):
        found.append(x)
        most = max(most, resident() - before)
    assert found == ["a", "b", "c"] and most > 250
    assert resident() - before < 100


def test_a_failing_task_still_fails():
    def run(batches):
        yield 1
        raise ValueError("as before")

    rows = lean(run)(iter(()))
    assert next(rows) == 1
    try:
        next(rows)
    except ValueError as e:
        assert str(e) == "as before"
    else:
        raise AssertionError("the error is lost")
