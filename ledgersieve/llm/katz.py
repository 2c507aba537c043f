"""Language-model scores of documents: a Katz backoff bigram model over all training text.

Tokens are words between white space, A-Z lower-cased, and an end after each text; the end
is also the context of a text's first token.  All counts are exact and cover all training
documents.

The model is defined over all words of the training texts and the unseen word:

    p(w | v) = d(c) c(v, w) / c(v)      if the pair occurs in training
             = a(v) p(w)                otherwise

``d`` are Good-Turing discounts of counts up to 5, ``a(v)`` gives what discounting leaves to
the words not seen after ``v``, so every p(. | v) sums to exactly one.  Single words are
discounted the same way, and what is left goes to the unseen word.

A caller may ask for a model over fewer words: the others, the unseen one included, then
form one class, p(word) = p(class) p(word | class), and pairs are pairs of classes.

Tables: words by hash; pair counts by bucket of pairs.  Pairs of the ``HEAD`` most frequent
words, the only ones that can hold a large share of all rows, are counted in every task
and added up, a table of HEAD**2 numbers.  All other pairs go to their bucket, packed per
batch of documents: a bucket adds up the counts of its pairs and sends each batch the
counts of the pairs it asked for.  So every document's pairs meet the counts in one
exchange there and one back, of a few bytes per pair.

That holds for pairs of the ``VOCABULARY`` most frequent words, whose table is broadcast.
Pairs with any other word are plain rows (:func:`loose`): they are dealt by that word, which
no pair count can make frequent, and the same formulas give their part of a score.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.store import parts, written

#: Class ids fit in 19 bits: 0 stands for other words, 1 the end, then words by rank.
WORD_BITS, DOC_BITS = 19, 12
VOCABULARY = (1 << WORD_BITS) - 1
HEAD = 512
LOW = 5  # counts up to this are discounted
OTHER, END = 0, 1
END_HASH = np.int64(0x0E4D0E4D0E4D0E4D)
#: Words without a class id are named by their hash with this sign, so no name is an id.
RARE = np.int64(-1 << 63)
U = np.uint64


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       (~held_out()).alias("learn"))


# --- words -----------------------------------------------------------------------------

def word_counts(rows: DataFrame) -> DataFrame:
    """(h, c) of all training words and the end, written."""
    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column(1))
            seen, number = [np.array([END_HASH])], [np.array([batch.num_rows])]
            for _, _, words in W.each_slice(batch.column(0), W.GRAPHIC):
                h, n = np.unique(words.hash.view(np.int64), return_counts=True)
                seen.append(h), number.append(n)
            h, back = np.unique(np.concatenate(seen), return_inverse=True)
            c = np.bincount(back, weights=np.concatenate(number)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[c > 0]), pa.array(c[c > 0])], names=["h", "c"])

    counted = rows.select("text", "learn").mapInArrow(run, "h long, c long")
    return written(counted.groupBy("h").agg(F.sum("c").alias("c")), "words")


def discounts(counts: np.ndarray) -> np.ndarray:
    """Good-Turing discounts d[0..LOW] from n[r], the number of things seen r times.

    Where the counts of counts give none (too little data), half a count is taken off.
    """
    r = np.arange(1, LOW + 1)
    plain = np.r_[1.0, (r - 0.5) / r]
    n = counts.astype(float)
    if (n[1 : LOW + 2] <= 0).any():
        return plain
    cut = (LOW + 1) * n[LOW + 1] / n[1]
    d = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if cut < 1 else np.zeros(LOW)
    return np.r_[1.0, d] if ((d > 0) & (d < 1)).all() else plain


class Lexicon(NamedTuple):
    hash: np.ndarray    # ascending hashes of the vocabulary
    id: np.ndarray      # their class ids
    count: np.ndarray   # training count by class id (of the other words, together)
    prob: np.ndarray    # p(class)
    total: int          # N
    distinct: int       # V
    d: np.ndarray       # discounts of single words
    new: float          # p(unseen word)
    scale: float        # 1, or less where nothing was discounted
    fold: bool          # other words are one class of the model


def lexicon(words: DataFrame, size: int = VOCABULARY, fold: bool = False) -> Lexicon:
    """The most frequent words (at most ``size`` rows) and what single words' probabilities need."""
    counts = [F.sum((F.col("c") == r).cast("long")).alias(f"n{r}") for r in range(1, LOW + 2)]
    row = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("v"), *counts).first()
    n = np.array([0, *(row[f"n{r}"] or 0 for r in range(1, LOW + 2))])
    total, d = int(row["t"]), discounts(n)
    left = float(((1 - d[1:]) * np.arange(1, LOW + 1) * n[1 : LOW + 1]).sum()) / max(total, 1)
    scale = 1.0
    if left <= 0:  # no rare word: the unseen one counts as one more token
        left = 1 / (total + 1)
        scale = total / (total + 1)
    first = (F.col("h") == F.lit(int(END_HASH))).desc()
    top = words.orderBy(first, F.desc("c"), "h").limit(size - 1).toArrow()
    h, c = top["h"].to_numpy(), top["c"].to_numpy()
    count = np.zeros(max(len(h), 1) + 1, np.int64)
    count[1 : len(h) + 1] = c
    count[OTHER] = total - c.sum()
    prob = np.where(count <= LOW, d[np.minimum(count, LOW)], 1.0) * count / max(total, 1) * scale
    prob[OTHER] = 0
    prob[OTHER] = max(1 - prob.sum(), 0)
    order = np.argsort(h)
    return Lexicon(h[order], (order + 1).astype(np.int64), count, prob, total, int(row["v"]), d, left, scale, fold)


def _classes(words: W.Words, lex: Lexicon):
    """Class of every token with the ends put in, the text each belongs to, and the words without a class."""
    h = words.hash.view(np.int64)
    at = np.minimum(np.searchsorted(lex.hash, h), max(len(lex.hash) - 1, 0))
    known = lex.hash[at] == h if len(lex.hash) else np.zeros(len(h), bool)
    found = np.where(known, lex.id[at] if len(lex.id) else 0, OTHER)
    texts = len(words.first) - 1
    tokens = np.insert(found, words.first[1:], END)
    owner = np.repeat(np.arange(texts), np.diff(words.first) + 1)
    return _before(tokens, words), tokens, owner, ~known


def _before(tokens: np.ndarray, words: W.Words) -> np.ndarray:
    before = np.r_[END, tokens[:-1]]
    before[words.first[:-1] + np.arange(len(words.first) - 1)] = END
    return before


# --- pairs -----------------------------------------------------------------------------

def _pack(*columns: np.ndarray) -> bytes:
    """Columns as byte planes, compressed; small numbers cost about a byte."""
    planes = [np.int64(len(columns[0])).tobytes()]
    for c in columns:
        c = np.ascontiguousarray(c)
        planes.append(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, at, out = int(raw[:8].view(np.int64)[0]), 8, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


REQUEST = (np.uint64, np.uint16, np.uint32)             # pair (differences), document and learn bit, how often
ANSWER = (np.uint32, np.uint32, np.uint16, np.uint32, np.uint32)  # context (differences), word if unseen, document, n, count


#: Bytes of text whose pairs are packed together; some dozen numbers of eight bytes a word are held for that.
BATCH_BYTES = 4 << 20
BUCKETS_A_TASK = 4


def _batches(batch: pa.RecordBatch):
    _, offsets = W.text_bytes(batch.column(1))
    for i, j in W.slices(offsets, BATCH_BYTES):
        for low in range(i, j, 1 << DOC_BITS):
            yield batch.slice(low, min(j - low, 1 << DOC_BITS))


def _pairs(batch: pa.RecordBatch, lex: Lexicon):
    """Head pair codes and (pair, document) of all tokens of a batch."""
    heads, others = [], []
    for i, _, words in W.each_slice(batch.column(1), W.GRAPHIC):
        v, w, owner, _ = _classes(words, lex)
        head = (v > OTHER) & (v <= HEAD) & (w > OTHER) & (w <= HEAD)
        doc = (owner + i).astype(np.uint64)
        heads.append((((v[head] - 1) * HEAD + w[head] - 1), doc[head]))
        other = ~head if lex.fold else ~head & (v > OTHER) & (w > OTHER)
        others.append(((v[other].astype(np.uint64) << U(WORD_BITS)) | w[other].astype(np.uint64), doc[other]))
    join = lambda xs: tuple(np.concatenate(c) for c in zip(*xs))
    return join(heads), join(others)


def requests(rows: DataFrame, lex, buckets: int) -> DataFrame:
    """(bucket, batch, what, data): packed pairs of each batch of documents for each bucket.

    With each batch go its counts of head pairs, and the keys of its documents in order.
    A batch is named by its partition and its place there, which a repeated task gives again.
    """
    def run(batches):
        name = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in _batches(whole):
                if not batch.num_rows:
                    continue
                (head, head_doc), (pair, doc) = _pairs(batch, lex.value)
                learn = batch.column(2).to_numpy(zero_copy_only=False)
                keys = batch.column(0).to_numpy()
                name += 1
                counts = np.bincount(head[learn[head_doc.astype(np.int64)]], minlength=HEAD * HEAD)
                data, bucket = [_pack(counts.astype(np.uint32)), _pack(keys)], [(name * 0x9E3779B1) % buckets] * 2
                place = (W.mix(pair) % U(buckets)) << U(WORD_BITS * 2 + DOC_BITS + 1)
                tail = (doc << U(1)) | learn[doc.astype(np.int64)].astype(np.uint64)
                key, n = np.unique(place | (pair << U(DOC_BITS + 1)) | tail, return_counts=True)
                border = np.searchsorted(key >> U(WORD_BITS * 2 + DOC_BITS + 1), np.arange(buckets + 1))
                pair = (key >> U(DOC_BITS + 1)) & U((1 << 2 * WORD_BITS) - 1)
                tail = (key & U((1 << DOC_BITS + 1) - 1)).astype(np.uint16)
                for b in np.flatnonzero(np.diff(border)):
                    these = slice(border[b], border[b + 1])
                    data.append(_pack(np.diff(pair[these], prepend=U(0)), tail[these], n[these].astype(np.uint32)))
                    bucket.append(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(bucket, np.int32)), pa.array([name] * len(data)), pa.array(["head", "docs"] + ["pairs"] * (len(data) - 2)),
                     pa.array(data, pa.binary())], names=["bucket", "batch", "what", "data"])

    return rows.select("k", "text", "learn").mapInArrow(run, "bucket int, batch long, what string, data binary")


def counted(asked: DataFrame, lex, buckets: int) -> DataFrame:
    """What the buckets make of the requests, written: kinds answer, docs, context, times and head."""
    schema = "kind string, batch long, data binary, id long, c array<double>"

    def rows(kind, batch=None, data=None, ids=None, values=None):
        n = len(ids if ids is not None else data if data is not None else values)
        values = None if values is None else np.asarray(values, np.float64)
        lists = pa.nulls(n, pa.list_(pa.float64())) if values is None else pa.ListArray.from_arrays(
            np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n), pa.array(batch, pa.int64()) if batch is not None else pa.nulls(n, pa.int64()),
             pa.array(data, pa.binary()) if data is not None else pa.nulls(n, pa.binary()),
             pa.array(ids, pa.int64()) if ids is not None else pa.nulls(n, pa.int64()), lists],
            names=["kind", "batch", "data", "id", "c"])

    def one(found, prob):
        names, blocks = zip(*found)
        columns = [_unpack(x, *REQUEST) for x in blocks]
        pair = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns])
        tail, n = (np.concatenate([c[i] for c in columns]) for i in (1, 2))
        block = np.repeat(np.arange(len(columns)), [len(c[0]) for c in columns])
        unique, back = np.unique(pair, return_inverse=True)
        count = np.bincount(back, weights=n * (tail & 1), minlength=len(unique)).astype(np.int64)
        times = np.bincount(np.minimum(count, LOW + 2), minlength=LOW + 3)[: LOW + 2]
        yield rows("times", values=[times])
        known = np.flatnonzero(count)
        context, word = (unique[known] >> U(WORD_BITS)).astype(np.int64), (unique[known] & U(VOCABULARY)).astype(np.int64)
        ids, at = np.unique(context, return_inverse=True)
        c = count[known]
        stats = [np.bincount(at, weights=c == r, minlength=len(ids)) for r in range(1, LOW + 1)]
        stats += [np.bincount(at, weights=np.where(c > LOW, c, 0), minlength=len(ids)),
                  np.bincount(at, weights=prob[word], minlength=len(ids))]
        if len(ids):
            yield rows("context", ids=ids, values=np.stack(stats, 1))
        c = count[back]
        context, word = (pair >> U(WORD_BITS)).astype(np.uint32), (pair & U(VOCABULARY)).astype(np.uint32)
        word[c > 0] = 0
        data = []
        for b in range(len(columns)):
            these = block == b if len(columns) < 64 else slice(*np.searchsorted(block, [b, b + 1]))
            data.append(_pack(np.diff(context[these], prepend=np.uint32(0)), word[these], tail[these] >> 1, n[these],
                              c[these].astype(np.uint32)))
        yield rows("answer", batch=names, data=data)

    def run(batches):
        prob, last, found = lex.value.prob, None, []
        heads = np.zeros(HEAD * HEAD, np.int64)
        for batch in batches:
            for bucket, name, what, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if what == "head":
                    heads += _unpack(data, np.uint32)[0]
                    continue
                if what == "docs":
                    yield rows("docs", batch=[name], data=[data])
                    continue
                if bucket != last and found:
                    yield from one(found, prob)
                    found = []
                last = bucket
                found.append((name, data))
        if found:
            yield from one(found, prob)
        seen = np.flatnonzero(heads)
        if len(seen):
            yield rows("head", ids=seen, values=heads[seen][:, None])

    dealt = asked.repartition(parts(asked.sparkSession), "bucket").sortWithinPartitions("bucket", "batch")
    return written(dealt.mapInArrow(run, schema), "pairs", ("kind",))


def loose(rows: DataFrame, lex) -> DataFrame:
    """(v, w, p, k, n, t): pairs of each document with a word that the lexicon lacks.

    ``n`` is how often the document holds the pair, ``t`` the same in training, ``p`` the
    probability of ``w`` if the lexicon has it.  Where other words are one class, the pairs
    have counts of their own and only the other word itself is told.
    """
    def run(batches):
        m: Lexicon = lex.value
        for batch in batches:
            learn = batch.column(2).to_numpy(zero_copy_only=False)
            keys = batch.column(0).to_numpy()
            for i, _, words in W.each_slice(batch.column(1), W.GRAPHIC):
                v, w, owner, new = _classes(words, m)
                name = w.copy()
                name[np.flatnonzero(new) + words.owner()[new]] = words.hash.view(np.int64)[new] | RARE
                here = (w == OTHER) if m.fold else (w == OTHER) | (v == OTHER)
                before = np.zeros(here.sum(), np.int64) if m.fold else _before(name, words)[here]
                after, w, of = name[here], w[here], owner[here]
                order = np.lexsort((after, before, of))
                after, before, w, of = after[order], before[order], w[order], of[order]
                first = np.ones(len(of), bool)
                first[1:] = (after[1:] != after[:-1]) | (before[1:] != before[:-1]) | (of[1:] != of[:-1])
                place = np.flatnonzero(first)
                n = np.diff(np.r_[place, len(of)]).astype(np.int32)
                of, w = of[place] + i, w[place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before[place]), pa.array(after[place]), pa.array(m.prob[w], mask=w == OTHER), pa.array(keys[of]),
                     pa.array(n), pa.array(np.where(learn[of], n, 0).astype(np.int32))], names=["v", "w", "p", "k", "n", "t"])

    return rows.select("k", "text", "learn").mapInArrow(run, "v long, w long, p double, k long, n int, t int")


def loose_counts(pairs: DataFrame, lex: Lexicon) -> DataFrame:
    """(v, p, k, n, c, cw, first): loose pairs with the counts of the pair and of its rare second word, written.

    All pairs of a rare second word meet in one place, and so do those of a rare first word
    with others; ``first`` marks one row a pair.
    """
    dealt = pairs.withColumn("key", F.when(F.col("w") < 0, F.col("w")).otherwise(F.col("v"))).repartition("key")
    pair = Window.partitionBy("key", "v", "w").orderBy("k")
    every = pair.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = dealt.select("key", "v", "w", "p", "k", "n", "t", (F.row_number().over(pair) == 1).alias("first"), F.sum("t").over(every).alias("c"))
    found = found.withColumn("cw", F.sum(F.when(F.col("w") < 0, F.col("t"))).over(Window.partitionBy("key")))
    c, many = F.col("cw"), max(lex.total, 1)
    low = F.element_at(F.array(*(F.lit(float(x)) for x in lex.d)), F.least(c, F.lit(LOW)).cast("int") + 1)
    single = F.when(c == 0, F.lit(lex.new)).when(c <= LOW, low * c * lex.scale / many).otherwise(c * lex.scale / many)
    return written(found.select("v", F.coalesce("p", single).alias("p"), "k", "n", "c", F.when(F.col("w") < 0, c).alias("cw"), "first"), "loose")


def _stats() -> list:
    """What a context's weights need of the pairs that begin with it: n[1..LOW], all counts above, the words' probabilities."""
    seen, c = F.col("first") & (F.col("c") > 0), F.col("c")
    once = [F.sum((seen & (c == r)).cast("double")) for r in range(1, LOW + 1)]
    return [*once, F.sum(F.when(seen & (c > LOW), c).otherwise(0).cast("double")), F.sum(F.when(seen, F.col("p")).otherwise(0.0))]


STATS = [f"s{i}" for i in range(LOW + 2)]


def weights(stats: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 a(v) and log10 of the denominator of contexts, whose statistics are columns of ``stats``."""
    r = np.arange(1, LOW + 1)[:, None]
    whole = (r * stats[:LOW]).sum(0) + stats[LOW]
    mass = (d[1:, None] * r * stats[:LOW]).sum(0) + stats[LOW]
    rest = np.maximum(1 - stats[LOW + 1], 0)
    # A context with no discounted pair counts one token more; one that no word is left for, none.
    whole = np.where((whole - mass < 1e-9) & (whole > 0), whole + 1, whole)
    whole = np.where(rest < 1e-12, mass, whole)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(whole > 0, np.log10((1 - mass / whole) / rest), 0.0), np.where(whole > 0, np.log10(whole), 0.0)


class Model(NamedTuple):
    lex: Lexicon
    d: np.ndarray        # discounts of pairs
    back: np.ndarray     # log10 a(v), by class
    whole: np.ndarray    # log10 of the denominator, by class
    head: np.ndarray     # log10 p(w | v) of head pairs


def estimate(table: DataFrame, lex: Lexicon, others: DataFrame) -> Model:
    """Discounts and backoff weights from the tables of counts; all of them bounded by the lexicon."""
    head = np.zeros(HEAD * HEAD, np.int64)
    got = table.where("kind = 'head'").groupBy("id").agg(F.sum(F.col("c")[0]).alias("c")).toArrow()
    head[got["id"].to_numpy()] = got["c"].to_numpy()
    sums = [F.coalesce(F.sum(F.col("c")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(LOW + 2)]
    row = table.where("kind = 'times'").agg(*sums).first()
    times = np.array(row, float) + np.bincount(np.minimum(head, LOW + 2), minlength=LOW + 3)[: LOW + 2]
    size = len(lex.prob)
    more = None
    if not lex.fold:
        # Contexts of the lexicon with rare words after them; the counts of all loose pairs under no context.
        stats = [c.alias(name) for c, name in zip(_stats(), STATS)]
        next_one = F.count_if(F.col("first") & (F.col("c") == LOW + 1)).alias("next")
        more = others.groupBy(F.when(F.col("v") >= 0, F.col("v")).alias("id")).agg(*stats, next_one).toArrow()
        for r in range(1, LOW + 1):
            times[r] += more[STATS[r - 1]].to_numpy().sum()
        times[LOW + 1] += more["next"].to_numpy().sum()
        more = more.filter(more["id"].is_valid())
    d = discounts(times)
    stats = np.zeros((LOW + 2, size))
    got = table.where("kind = 'context'").groupBy("id").agg(*sums).toArrow()
    for i in range(LOW + 2):
        stats[i, got["id"].to_numpy()] = got[f"s{i}"].to_numpy()
    place = np.flatnonzero(head)
    v, w, c = place // HEAD + 1, place % HEAD + 1, head[place]
    for r in range(1, LOW + 1):
        np.add.at(stats[r - 1], v, c == r)
    np.add.at(stats[LOW], v, np.where(c > LOW, c, 0))
    np.add.at(stats[LOW + 1], v, lex.prob[w])
    if more is not None:
        for i, name in enumerate(STATS):
            stats[i, more["id"].to_numpy()] += more[name].to_numpy()
    back, whole = weights(stats, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        v, w = np.divmod(np.arange(HEAD * HEAD), HEAD)
        v, w = np.minimum(v + 1, size - 1), np.minimum(w + 1, size - 1)
        seen = np.log10(np.where(head <= LOW, d[np.minimum(head, LOW)], 1) * head) - whole[v]
        logs = np.where(head > 0, seen, back[v] + np.log10(lex.prob[w]))
    return Model(lex, d, back, whole, logs)


# --- scores ----------------------------------------------------------------------------

def _facts(rows: DataFrame, model) -> DataFrame:
    """Per document what needs no join: tokens, the head's part and sums over the words of the lexicon."""
    schema = "doc_id long, k long, learn boolean, n_tokens long, known long, base double, part double"

    def run(batches):
        m: Model = model.value
        lex = m.lex
        base = np.log10((lex.count + 1) / (lex.total + lex.distinct + 1))
        base[OTHER] = 0
        for batch in batches:
            for i, j, words in W.each_slice(batch.column(2), W.GRAPHIC):
                v, w, owner, _ = _classes(words, lex)
                texts = j - i
                total = lambda x: np.bincount(owner, weights=x, minlength=texts)  # noqa: B023, E731
                head = (v > OTHER) & (v <= HEAD) & (w > OTHER) & (w <= HEAD)
                part = np.zeros(len(w))
                part[head] = m.head[(v[head] - 1) * HEAD + w[head] - 1]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, texts) for c in (0, 1, 3)), pa.array(np.bincount(owner, minlength=texts)),
                     pa.array(total((w != OTHER) & (lex.count[w] > 0)).astype(np.int64)), pa.array(total(base[w])), pa.array(total(part))],
                    names=["doc_id", "k", "learn", "n_tokens", "known", "base", "part"])

    return written(rows.select("doc_id", "k", "text", "learn").mapInArrow(run, schema), "facts")


def _answered(table: DataFrame, model, buckets: int) -> DataFrame:
    """(k, pairs): what the pairs outside the head add to each document's score."""
    def run(batches):
        m: Model = model.value
        with np.errstate(divide="ignore"):
            lower = np.log10(m.lex.prob)
        last, sums, keys = None, None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums[: len(keys)])], names=["k", "pairs"])
        for batch in batches:
            for name, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if name != last:
                    if keys is not None:
                        yield out()
                    last, sums, keys = name, np.zeros(1 << DOC_BITS), None
                if kind == "docs":
                    keys = _unpack(data, np.int64)[0]
                    continue
                v, w, doc, n, c = _unpack(data, *ANSWER)
                v = np.cumsum(v, dtype=np.uint32).astype(np.int64)
                c = c.astype(np.int64)
                with np.errstate(divide="ignore"):
                    seen = np.log10(np.where(c <= LOW, m.d[np.minimum(c, LOW)], 1) * c) - m.whole[v]
                value = np.where(c > 0, seen, m.back[v] + lower[w])
                sums += np.bincount(doc, weights=value * n, minlength=1 << DOC_BITS)
        if keys is not None:
            yield out()

    answers = table.where("kind in ('answer', 'docs')").select("batch", "kind", "data")
    return answers.repartition(buckets, "batch").sortWithinPartitions("batch").mapInArrow(run, "k long, pairs double")


def _loose_values(counts: DataFrame, model, fold: bool) -> DataFrame:
    """(k, n, cw, part): what each loose pair adds to its document's score."""
    def run(batches):
        m: Model = model.value
        for batch in batches:
            v, p, n, c = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("v", "p", "n", "c"))
            if fold:
                value = np.log10(p) - np.log10(max(m.lex.prob[OTHER], 1e-300))
            else:
                if "s0" in batch.schema.names:
                    back, whole = weights(np.stack([batch.column(x).to_numpy() for x in STATS]), m.d)
                else:
                    back, whole = m.back[v], m.whole[v]
                with np.errstate(divide="ignore"):
                    seen = np.log10(np.where(c <= LOW, m.d[np.minimum(c, LOW)], 1) * c) - whole
                    value = np.where(c > 0, seen, back + np.log10(p))
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), batch.column("cw"), pa.array(value * n)],
                                             names=["k", "n", "cw", "part"])

    kept, schema = ["v", "p", "k", "n", "c", "cw"], "k long, n int, cw long, part double"
    values = counts.where("v >= 0").select(*kept).mapInArrow(run, schema)
    if fold:
        return values
    context = Window.partitionBy("v")
    stats = [c.over(context).alias(name) for c, name in zip(_stats(), STATS)]
    return values.unionAll(counts.where("v < 0").select(*kept, *stats).mapInArrow(run, schema))


def lm_scores(docs: DataFrame, vocabulary: int | None = None, held: int = VOCABULARY) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id) mod 7 is not 2.  A null text reads as an
    empty one, whose only token is the end; a null doc_id is not held out.  Repeated rows
    are learnt and scored each.  Other columns are left aside.

    The model is over all words.  With ``vocabulary`` it is over that many of the most
    frequent ones, and all others are one class.  ``held`` is the number of words whose
    table is broadcast; no result depends on it.
    """
    spark = docs.sparkSession
    # A task takes its buckets one after the other, and holds the pairs of one.
    buckets = min(parts(spark) * BUCKETS_A_TASK, 1 << 13)
    fold = vocabulary is not None
    rows = source(docs).withColumn("k", F.xxhash64("doc_id", "text"))
    words = word_counts(rows)
    lex = lexicon(words, min(vocabulary if fold else held, VOCABULARY), fold)
    shared = spark.sparkContext.broadcast(lex)
    table = counted(requests(rows, shared, buckets), shared, buckets)
    others = loose_counts(loose(rows, shared), lex)
    shared.destroy()
    model = estimate(table, lex, others)
    shared_model = spark.sparkContext.broadcast(model)
    facts = _facts(rows, shared_model)
    many = float(lex.total + lex.distinct + 1)
    # No row of a document has a partner in its task, so the rows are sent as they are and summed there.
    rare = _loose_values(others, shared_model, fold).repartition("k").groupBy("k").agg(
        F.sum(F.when(F.col("cw").isNotNull(), F.col("n") * F.log10((F.col("cw") + 1) / F.lit(many)))).alias("rare_base"),
        F.sum(F.when(F.col("cw") > 0, F.col("n"))).alias("rare_known"), F.sum("part").alias("rare_part"))
    copies = facts.groupBy("k").agg(F.count(F.lit(1)).alias("copies"))
    pairs = _answered(table, shared_model, min(parts(spark), 1 << 14)).groupBy("k").agg(F.max("pairs").alias("pairs"))
    rare = copies.join(rare, "k", "left").join(pairs, "k", "left")
    share = lambda name: F.coalesce(F.col(name) / F.col("copies"), F.lit(0.0))
    return facts.select("doc_id", "k", "learn", "n_tokens", "known", "base", "part").join(rare, "k").select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens",
        (F.col("known") + share("rare_known")).cast("long").alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + share("rare_base")).alias("base_score"),
        (F.col("part") + F.coalesce("pairs", F.lit(0.0)) + share("rare_part")).alias("score"))
