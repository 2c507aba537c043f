"""Byte-level BPE encoding through a table of distinct words, and decoding through pieces.

Texts are split into words by the tokenizer's own splitting rule, vectorised over bytes.
Documents are taken in blocks of about ``BLOCK_BYTES``.  A block sends each of its distinct
words once to the word's bucket; a bucket holds a part of the table of distinct words, has
every one of them encoded once, and sends each block the ids of the words it asked for, in
their order.  The block's texts, packed, meet these ids by a shuffle.  Decoding looks each id
up among the pieces, a table as long as the vocabulary.

Words meet by a 64-bit hash; among n distinct words two are confused with probability
n*n / 2**65, 3e-5 for 30 million.
"""

from __future__ import annotations

import functools
import hashlib
import json
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.store import lean, parts

#: Distinct words that a task has encoded at a time.
HEAD_WORDS = 1 << 16
BLOCK_BYTES = 2 << 20
SLICE_BYTES = 1 << 18
BUCKETS_A_TASK = 4
LETTER, NUMBER, OTHER, SPACE, SPECIAL = range(5)


@functools.cache
def _classes(path: str) -> np.ndarray:
    """Class of every code point: letter, number, white space or other.

    Where two versions of the Unicode tables differ, the tokenizer itself is asked.
    """
    import unicodedata

    import regex

    # Arrays and one text only: a list of all code points would take some 50 MB in every worker.
    place = np.r_[np.arange(0xD800, dtype=np.int32), np.arange(0xE000, 0x110000, dtype=np.int32)]
    every = place.astype("<u4").tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[place[m.start() : m.end()]] = kind
    known = {"L": LETTER, "N": NUMBER}
    cut = _tokenizer(path).pre_tokenizer.pre_tokenize_str
    for at, char in enumerate(every):
        point = place[at]
        kind = table[point]
        if kind != SPACE and kind != known.get(unicodedata.category(char)[0], OTHER):
            size = [b - a for _, (a, b) in cut(f"a{char}1")]
            table[point] = LETTER if size == [2, 1] else NUMBER if size == [1, 2] else OTHER
    return table


def byte_classes(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of the character each byte belongs to."""
    kind = table[:256].take(raw)
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        b = raw[lead].astype(np.int64)
        at = lambda k: raw[np.minimum(lead + k, len(raw) - 1)].astype(np.int64) & 0x3F
        two, three = b < 0xE0, (b >= 0xE0) & (b < 0xF0)
        point = np.where(two, (b & 0x1F) << 6 | at(1), np.where(
            three, (b & 0x0F) << 12 | at(1) << 6 | at(2), (b & 0x07) << 18 | at(1) << 12 | at(2) << 6 | at(3)))
        found = table[np.minimum(point, 0x10FFFF)]
        kind[lead] = found
        for k, wide in ((1, slice(None)), (2, ~two), (3, ~two & ~three)):
            where = lead[wide] + k
            inside = where < len(raw)
            kind[where[inside]] = found[wide][inside]
    return kind


def split(raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray, specials: tuple[bytes, ...] = ()):
    """(start, end, first): words of texts by the rule of byte-level BPE; first word per text.

    Contractions, then runs of letters, of numbers and of other signs, each with at most
    one space before it; white space otherwise, whose last character stands alone if a
    word follows.  A special token is one word, and text before it ends there.
    """
    n = len(raw)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = byte_classes(raw, classes)
    forced = np.zeros(n + 1, bool)
    forced[offsets] = True
    data = raw.tobytes() if specials else b""
    for token in specials:
        at = data.find(token)
        while at >= 0:
            text_end = offsets[np.searchsorted(offsets, at, "right")]
            if at + len(token) <= text_end:
                kind[at : at + len(token)] = SPECIAL
                forced[at] = forced[at + len(token)] = True
                at = data.find(token, at + len(token))
            else:
                at = data.find(token, at + 1)
    lead = (raw & 0xC0) != 0x80  # a character begins here
    begin = np.ones(n + 1, bool)
    begin[1:n] = kind[1:] != kind[:-1]
    begin |= forced
    # The last character of white space before a word of the same text.
    follows = np.flatnonzero(begin[1:n] & ~forced[1:n] & (kind[:-1] == SPACE) & (kind[1:] != SPECIAL)) + 1
    if len(follows):
        last = follows - 1
        while (back := ~lead[last]).any():
            last = last - back
        begin[last] = True
        begin[follows[raw[last] == 32]] = False
    # Contractions: an apostrophe that begins a word of its own.
    tick = np.flatnonzero((raw == 39) & begin[:n])
    if len(tick):
        far = lambda k: np.where(tick + k < n, raw[np.minimum(tick + k, n - 1)], 0)
        one, two = far(1), far(2)
        border = np.searchsorted(offsets, tick, "right")
        room = offsets[border] - tick
        # The sign must not carry on as a run: a letter follows it.
        short = np.isin(one, list(b"stmd")) & (room >= 2)
        long = (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                | ((one == ord("l")) & (two == ord("l")))) & (room >= 3)
        for these, size in ((tick[short], 2), (tick[long], 3)):
            begin[these + 1] = False
            begin[these + size] = True
    start = np.flatnonzero(begin[:n])
    return start, np.r_[start[1:], n], np.searchsorted(start, offsets)


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start : start + size]``, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(start - (ends - size), size)]


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _vocabulary(path: str):
    """Specials, and for each id its bytes and its decimal with a comma, as flat arrays."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    pieces = {i: bytes(byte_of[c] for c in p) for p, i in spec["model"]["vocab"].items() if i not in added} | added
    size = max(pieces) + 1
    table = [pieces.get(i, b"") for i in range(size)]
    decimals = [b"%d," % i for i in range(size)]
    flat = lambda xs: (np.frombuffer(b"".join(xs), np.uint8), np.cumsum([0, *map(len, xs)]))
    return tuple(added.values()), flat(table), flat(decimals)


class Tables(NamedTuple):
    classes: np.ndarray            # class of every code point
    specials: tuple[bytes, ...]
    piece: np.ndarray              # bytes of all pieces, and where each id's begin
    piece_at: np.ndarray
    decimal: np.ndarray            # the same for decimals with a comma
    decimal_at: np.ndarray


def tables(spark: SparkSession, path: str) -> Tables:
    """What the tokenizer's file says, some MB, read by one task, so that only encoding needs the tokenizer in a worker."""
    def run(batches):
        for _ in batches:
            specials, piece, decimal = _vocabulary(path)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((_classes(path), specials, *piece, *decimal))], pa.binary())], names=["data"])

    return Tables(*pickle.loads(spark.range(0, 1, 1, 1).mapInArrow(lean(run), "data binary").first()["data"]))


def _words_of(raw: np.ndarray, offsets: np.ndarray, t: Tables):
    """For each slice: first and end text, the bytes, word borders and hashes."""
    for i, j in W.slices(offsets, SLICE_BYTES):
        part, borders = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        start, end, first = split(part, borders, t.classes, t.specials)
        yield i, j, part, start, end, first, W.word_hash(part, start, end) if len(part) else np.empty(0, np.uint64)


def _packed(size: np.ndarray, flat: np.ndarray) -> bytes:
    """Lists of numbers, as their sizes and the numbers one after the other; by byte planes, compressed."""
    planes = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(np.int64(len(size)).tobytes() + planes(size.astype(np.uint32)) + planes(flat))


def _unpacked(data: bytes, kind) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, wide = int(raw[:8].view(np.int64)[0]), np.dtype(kind).itemsize
    planes = lambda x, width, kind: np.ascontiguousarray(x.reshape(width, -1).T).view(kind).ravel()
    return planes(raw[8 : 8 + 4 * n], 4, np.uint32).astype(np.int64), planes(raw[8 + 4 * n :], wide, kind)


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(name, rows) of each block of documents.

    The name holds the block's place and its texts: input that reads otherwise a second time
    gives a name without ids, never another block's ids.
    """
    place = TaskContext.get().partitionId() << 32
    for batch in batches:
        raw, offsets = W.text_bytes(batch.column(1))
        for i, j in W.slices(offsets, BLOCK_BYTES):
            place += 1
            name = hashlib.blake2b(place.to_bytes(8, "little"), digest_size=8)
            name.update(offsets[i : j + 1] - offsets[i])
            name.update(raw[offsets[i] : offsets[j]])
            yield int.from_bytes(name.digest(), "little", signed=True), batch.slice(i, j - i)


def _by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ascending hashes by bucket, and the borders of the buckets in it."""
    bucket = (W.mix(h) % W.U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def asked(rows: DataFrame, shared, buckets: int) -> DataFrame:
    """(block, bucket, data): the distinct words of each block, by bucket and ascending hash."""
    def run(batches):
        for name, batch in _blocks(batches):
            seen, sizes, kept = [], [], []
            for _, _, part, start, end, _, h in _words_of(*W.text_bytes(batch.column(1)), shared.value):
                unique, at = np.unique(h, return_index=True)
                size = end[at] - start[at]
                seen.append(unique), sizes.append(size), kept.append(gather(part, start[at], size))
            h, size, flat = map(np.concatenate, (seen, sizes, kept))
            begin = np.cumsum(size) - size
            h, at = np.unique(h, return_index=True)
            order, border = _by_bucket(h, buckets)
            at = at[order]
            there = np.flatnonzero(np.diff(border))
            data = [_packed(size[x], gather(flat, begin[x], size[x])) for x in (at[border[b] : border[b + 1]] for b in there)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(data), pa.int64()), pa.array(there.astype(np.int32)), pa.array(data, pa.binary())],
                                             names=["block", "bucket", "data"])

    return rows.mapInArrow(lean(run), "block long, bucket int, data binary")


def answered(words: DataFrame, path: str, at_once: int) -> DataFrame:
    """(block, bucket, data): the ids of the words that each block asked for, in the same order; every distinct word is encoded once."""
    def encode(tokenizer, flat, start, size):
        counts, found = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for low in range(0, len(start), max(at_once, 1)):
            here = slice(low, low + max(at_once, 1))
            ids = [tokenizer.encode(flat[a : a + n].tobytes().decode(), add_special_tokens=False).ids for a, n in zip(start[here], size[here])]
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            found.append(np.fromiter((i for x in ids for i in x), np.int32, counts[-1].sum()))
        return np.concatenate(counts), np.concatenate(found)

    def answer(tokenizer, bucket, names, data):
        sizes, flats = zip(*(_unpacked(x, np.uint8) for x in data))
        ends = [np.cumsum(x) for x in sizes]
        h = np.concatenate([W.word_hash(f, e - n, e) for f, e, n in zip(flats, ends, sizes)])
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        _, at, back = np.unique(h, return_index=True, return_inverse=True)
        n, ids = encode(tokenizer, flat, (np.cumsum(size) - size)[at], size[at])
        first, border = np.cumsum(n) - n, np.cumsum([0, *map(len, sizes)])
        lists = (back[a:b] for a, b in zip(border[:-1], border[1:]))
        out = [_packed(n[x], gather(ids, first[x], n[x])) for x in lists]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([bucket] * len(out), pa.int32()), pa.array(out, pa.binary())],
                                          names=["block", "bucket", "data"])

    def run(batches):
        tokenizer, last, names, data = _tokenizer(path), None, [], []
        for batch in batches:
            for name, bucket, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != last and names:
                    yield answer(tokenizer, last, names, data)
                    names, data = [], []
                last = bucket
                names.append(name), data.append(words)
        if names:
            yield answer(tokenizer, last, names, data)

    dealt = words.repartition(parts(words.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lean(run), "block long, bucket int, data binary")


def _texts(rows: DataFrame) -> DataFrame:
    """(block, bucket, data): the documents of each block, packed, before all its buckets."""
    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for name, batch in _blocks(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
                stream.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([-1], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["block", "bucket", "data"])

    return rows.mapInArrow(lean(run), "block long, bucket int, data binary")


def encode_decode(docs: DataFrame, path: str, digests: bool = True, head_words: int = HEAD_WORDS) -> DataFrame:
    """Encode each row's whole text, and decode the ids again.

    With ``digests``: doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas)
    and decoded_sha256.  Without: doc_id, ids (array<int>) and decoded (string).

    A null text reads as an empty one and has no ids; null doc_ids, repeated rows and
    very long texts are encoded like any other; other columns are left aside; an empty
    table gives no rows.  ``path`` is the tokenizer's file on every executor.  A task has
    ``head_words`` distinct words encoded at a time; no result depends on it.  ``docs`` is
    read twice and must give the same rows in the same order, as a stored table does.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = min(parts(spark) * BUCKETS_A_TASK, 1 << 14)
    shared = spark.sparkContext.broadcast(tables(spark, path))
    both = _texts(source).unionAll(answered(asked(source, shared, buckets), path, head_words))

    def block(documents: pa.Table, answers: list[bytes]):
        t: Tables = shared.value
        raw, offsets = W.text_bytes(documents.column("text"))
        cut = [(i, j, first, h) for i, j, _, _, _, first, h in _words_of(raw, offsets, t)]
        unique, back = np.unique(np.concatenate([x[3] for x in cut]), return_inverse=True)
        sizes, flats = zip(*(_unpacked(x, np.int32) for x in answers)) if answers else ([np.empty(0, np.int64)], [np.empty(0, np.int32)])
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        if len(size) != len(unique):
            raise ValueError("the documents read otherwise a second time: write them first")
        order, _ = _by_bucket(unique, buckets)
        count, begin = np.empty(len(unique), np.int64), np.empty(len(unique), np.int64)
        count[order], begin[order] = size, np.cumsum(size) - size
        low = 0
        for i, j, first, h in cut:
            at = back[low : low + len(h)]
            low += len(h)
            ids = gather(flat, begin[at], count[at])
            border = np.r_[0, np.cumsum(count[at])][first]
            piece_size = (t.piece_at[1:] - t.piece_at[:-1])[ids]
            text = gather(t.piece, t.piece_at[ids], piece_size).tobytes()
            text_at = np.r_[0, np.cumsum(piece_size)][border]
            if digests:
                digit_size = (t.decimal_at[1:] - t.decimal_at[:-1])[ids]
                digits = gather(t.decimal, t.decimal_at[ids], digit_size).tobytes()
                digit_at = np.r_[0, np.cumsum(digit_size)][border]
            rows = []
            for n in range(j - i):
                decoded = text[text_at[n] : text_at[n + 1]].decode("utf-8", "replace")
                if digests:
                    line = digits[digit_at[n] : digit_at[n + 1]][:-1]
                    rows.append((int(border[n + 1] - border[n]), hashlib.sha256(line).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    rows.append((ids[border[n] : border[n + 1]], decoded))
            kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [documents.column("doc_id").slice(i, j - i).combine_chunks(), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", "decoded"])

    def run(batches):
        last, documents, answers = None, None, []
        for batch in batches:
            for name, bucket, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if name != last:
                    if documents is not None:
                        yield from block(documents, answers)
                    last, documents, answers = name, None, []
                if bucket < 0:
                    documents = pa.ipc.open_stream(data).read_all()
                elif documents is None:
                    raise ValueError("the documents read otherwise a second time: write them first")
                else:
                    answers.append(data)
        if documents is not None:
            yield from block(documents, answers)

    dealt = both.repartition(parts(spark), "block").sortWithinPartitions("block", "bucket")
    return dealt.mapInArrow(lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
                            else "doc_id long, ids array<int>, decoded string")
