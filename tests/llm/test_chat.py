from __future__ import annotations

import hashlib

import pytest

from ledgersieve.llm import chat
from ledgersieve.llm.store import ship

HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant", "\\", "\\\\<|", "<\\|im_sep|>", "<|", "a\\", "", None, "  \n\n", "日本😀 <|im_sep|>"]


def table(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, tree string, place long")


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] is not None, x[3] or ""))]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_every_text_comes_back(spark):
    rows = [(n, 0, "user", t) for n, t in enumerate(HARD)] + [(n, 1, "assistant", t) for n, t in enumerate(HARD)]
    rows += [(50, n, "assistant" if n % 2 else "user", HARD[n % len(HARD)]) for n in range(70)]
    rows += [(60, 1, None, "no role"), (60, 1, None, "no role"), (60, None, "assistant", "no turn"), (60, 1, "a\n<|im_sep|>", "odd role"), (None, 3, "user", "no conversation")]
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.format_digests(table(spark, rows)).collect()}
    assert found == plain(rows)


def test_probe_and_empty_table(spark):
    (r,) = chat.format_digests(chat.with_probe(table(spark, []))).collect()
    assert (r["conv_id"], r["n_turns"], r["loss_chars"]) == (-1, 2, len(chat.PROBE))
    assert chat.format_digests(table(spark, [])).count() == 0


def test_branches_are_ranked_by_mean_score(spark):
    # 1 - 2 - 4; 1 - 3 - 5 - 6; 7 answers a message that is not there; 8 and 9 answer each other.
    nodes = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 4, 2, None), ("t", 3, 1, 3.0), ("t", 5, 3, 3.0), ("t", 6, 5, 3.0), ("t", 7, 99, 9.0), ("t", 8, 9, 50.0), ("t", 9, 8, 50.0)]
    messages = spark.createDataFrame([(t, n, p, s, "assistant", f"m{n}") for t, n, p, s in nodes], "tree string, node long, parent long, score double, role string, text string")
    ranked = {}
    for r in chat.paths(messages, 9).orderBy("rank", "place").collect():
        ranked.setdefault(r["rank"], []).append(r["node"])
    assert ranked == {1: [7], 2: [1, 3, 5, 6], 3: [1, 2, 4]}
    best = chat.formatted(messages.where("node not in (7, 8, 9)"), 1).collect()
    assert len(best) == 1 and [best[0]["formatted"][a:b] for a, b in best[0]["mask"]] == ["m1", "m3", "m5", "m6"]


@pytest.mark.parametrize("depth", [1, 2, 3, 8, 9, 100])
def test_long_chains(spark, depth):
    (r,) = chat.format_digests(table(spark, [(1, n, "user", str(n)) for n in range(depth)])).collect()
    assert r["n_turns"] == depth
