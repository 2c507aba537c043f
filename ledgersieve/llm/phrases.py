"""Phrase collocations by dynamic itemset counting.

The texts are written once, dealt to ``SHARDS`` shards by a hash, and the shards are
scanned in a cycle.  Words are counted from the first scan on.  A phrase becomes active
after the scan in which the counts of both its parts (all its words but the last, and all
but the first) have reached the threshold; so phrases of different lengths are counted in
one scan.  An active phrase is counted until it has met every shard once.  A phrase that
reaches the threshold has parts that do so no later than their own cycle ends, hence the
counts of all frequent phrases are whole.

Counts between scans are a written table (language and phrase, total, shards met, scan of
reaching); a scan's counts are added by one aggregation.  Rows whose cycle is over below
the threshold leave it.  A task learns what is active from two tables of 2**23 bytes,
whatever the input: a bit for each scan in which a phrase of that bucket has reached the
threshold.  Phrases that share a bucket may be counted outside their cycle; a shard is
counted once only, so no count is wrong, and what was counted in part stays below its
true count.  Phrases are compared as strings; hashes only choose the bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgersieve.llm import words as W
from ledgersieve.llm.store import parts, written

#: Shards of the cycle; scans in which words or pairs reach the threshold have to fit eight bits, so 4 at most.
SHARDS = 2
THRESHOLD, BEST = 10, 2000
#: A shorter phrase goes if a longer candidate that holds it has at least this part of its count, in hundredths.
COVER = 50
SCALE = 1_000_000
BUCKET_BITS = 23
#: Bytes of text that are counted together in a task.
SLICE_BYTES = 3 << 20

# What ends a piece, and what parts words.
_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", 10, 11, 12, 13]] = True
_WORD = ~_PIECE
_WORD[[32, 9]] = False
_INSIDE = np.ones(256, bool)
_INSIDE[32] = False
#: Parts language and phrase in a key; no phrase holds it.
_BREAK = "\n"
#: A counted key is packed: its total above, then a bit for each shard met, then the scan of reaching the threshold, from 1.
_MET, _REACH = 16, 8
_LOWEST = np.array([255, *((x & -x).bit_length() - 1 for x in range(1, 256))], np.uint8)
_HIGHEST = np.array([0, *(x.bit_length() - 1 for x in range(1, 256))], np.uint8)


def _lang_hash(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return W.span_hash(W.BYTE_VALUE[raw], np.array([0]), np.array([len(raw)]))[0]


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return W.mix(left * np.uint64(3) + right)


def _word_hashes(phrases: pa.Array, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each phrase); ``lang`` has a hash for each phrase."""
    raw, offsets = W.text_bytes(phrases)
    _, start, end, first = W.borders(raw, offsets, _INSIDE)
    with np.errstate(over="ignore"):
        return W.mix(W.span_hash(W.BYTE_VALUE[raw], start, end) ^ np.repeat(lang, np.diff(first))), first


class Activity:
    """Scans in which the phrases of a bucket reached the threshold, for words and for pairs."""

    def __init__(self, bits: int = BUCKET_BITS):
        self.bits, self.tables = bits, {n: np.zeros(1 << bits, np.uint8) for n in (1, 2)}

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def active(self, n: int, left: np.ndarray, right: np.ndarray, scan: int, shards: int) -> np.ndarray:
        """Whether phrases whose parts have ``n`` words and these hashes may have to be counted in this scan."""
        a, b = (self.tables[n][self.bucket(x)] for x in (left, right))
        late = np.maximum(_HIGHEST[a], _HIGHEST[b]).astype(np.int64)
        return (np.maximum(_LOWEST[a], _LOWEST[b]) < scan) & (late >= scan - shards)

    def over(self, n: int, left: np.ndarray, right: np.ndarray, scan: int, shards: int) -> np.ndarray:
        """Whether the cycles of such phrases have ended with this scan for certain."""
        a, b = (self.tables[n][self.bucket(x)] for x in (left, right))
        return np.maximum(_HIGHEST[a], _HIGHEST[b]).astype(np.int64) <= scan - shards


def _phrases(lang: str, texts: pa.Array, scan: int, shards: int, activity: Activity):
    """(key, count) of a slice of texts of one language; the empty phrase is the number of words."""
    raw, offsets = W.text_bytes(texts)
    text, start, end, first = W.borders(raw, offsets, _WORD)
    if not len(start):
        return
    coded = W.strings(text, start, end).dictionary_encode()
    word, names = coded.indices.to_numpy(), coded.dictionary
    size = len(names)
    sign = lambda x: pa.scalar(x, names.type)

    def out(counts, *words):
        """Keys of phrases given by their words' places in ``names``."""
        spaced = pc.binary_join_element_wise(*(names.take(pa.array(x)) for x in words), sign(" "))
        return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(sign(lang), spaced, sign(_BREAK)).cast(pa.string()), pa.array(counts)], names=["key", "count"])

    if scan < shards:
        yield pa.RecordBatch.from_arrays([pa.array([lang + _BREAK]), pa.array([len(word)])], names=["key", "count"])
        yield out(np.bincount(word, minlength=size), np.arange(size))
    if not scan:
        return
    broken = np.r_[0, np.cumsum(_PIECE[text])]
    near = broken[start[1:]] == broken[end[:-1]]
    inner = first[(first > 0) & (first < len(start))]
    near[inner - 1] = False
    del broken, start, end, text
    hashes, _ = _word_hashes(names, np.full(size, _lang_hash(lang)))
    hashes, word = hashes[word], word.astype(np.int64)
    pair = np.flatnonzero(near)
    counted = pair[activity.active(1, hashes[pair], hashes[pair + 1], scan, shards)]
    if len(counted):
        key, count = np.unique(word[counted] * size + word[counted + 1], return_counts=True)
        yield out(count, key // size, key % size)
    three = np.flatnonzero(near[:-1] & near[1:])
    left, right = _join(hashes[three], hashes[three + 1]), _join(hashes[three + 1], hashes[three + 2])
    three = three[activity.active(2, left, right, scan, shards)]
    if len(three):
        pairs, place = np.unique(word[three] * size + word[three + 1], return_inverse=True)
        key, count = np.unique(place * size + word[three + 2], return_counts=True)
        head = pairs[key // size]
        yield out(count, head // size, head % size, key % size)


def scanned(shard: DataFrame, scan: int, shards: int, activity) -> DataFrame:
    """(key, count), several rows a phrase, of what is active in this scan."""
    def run(batches):
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            code = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(code == k)
                _, offsets = W.text_bytes(batch.column(1))
                ends = np.r_[0, np.cumsum(np.diff(offsets)[mine])]
                for i, j in W.slices(ends, SLICE_BYTES):
                    yield from _phrases(lang, batch.column(1).take(pa.array(mine[i:j])), scan, shards, activity.value)

    return shard.select("lang", "text").mapInArrow(run, "key string, count long")


def _split(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each phrase, hash of each word, first word of each phrase) of keys."""
    both = pc.split_pattern(keys, _BREAK, max_splits=1, reverse=True).flatten()
    even = np.arange(0, len(both), 2)
    langs, phrases = both.take(pa.array(even)).dictionary_encode(), both.take(pa.array(even + 1))
    lang = np.array([_lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
    h, first = _word_hashes(phrases, lang)
    return np.diff(first), h, first[:-1]


def _kept(state: DataFrame, scan: int, shards: int, threshold: int, activity) -> DataFrame:
    """``state`` without the rows whose cycle is over below the threshold."""
    def run(batches):
        for batch in batches:
            rare = np.flatnonzero(batch.column("packed").to_numpy() >> _MET < threshold)
            if len(rare):
                n, h, first = _split(batch.column("key").take(pa.array(rare)))
                over = (n == 1) & (scan >= shards - 1)
                for k, sides in ((2, lambda f: (h[f], h[f + 1])), (3, lambda f: (_join(h[f], h[f + 1]), _join(h[f + 1], h[f + 2])))):  # noqa: B023
                    over[n == k] = activity.value.over(k - 1, *sides(first[n == k]), scan, shards)
                stay = np.ones(batch.num_rows, bool)
                stay[rare[over]] = False
                batch = batch.filter(pa.array(stay))
            yield batch

    return state.mapInArrow(run, state.schema)


def _reach() -> Column:
    return F.col("packed").bitwiseAND((1 << _REACH) - 1) - 1


def _learn(state: DataFrame, scan: int, activity: Activity) -> bool:
    """Note the words and pairs that reached the threshold in this scan, and whether there are any; at most 2**21 rows come to the driver."""
    bits = np.uint64(64 - activity.bits)

    def run(batches):
        for batch in batches:
            n, h, first = _split(batch.column(0))
            short = (n == 1) | (n == 2)
            n, first = n[short], first[short]
            key = h[first] if len(first) else np.empty(0, np.uint64)
            two = n == 2
            key[two] = _join(key[two], h[first[two] + 1])
            yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int32)), pa.array((key >> bits).astype(np.int64))], names=["n", "bucket"])

    new = state.where(_reach() == scan).select("key")
    rows = new.mapInArrow(run, "n int, bucket long").groupBy("n", F.shiftright("bucket", 3).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(8 * (bucket & 7) + {min(scan, 7)} as int))")).alias("bits")).toArrow()
    for n, table in activity.tables.items():
        mine = rows.filter(pc.equal(rows["n"], n))
        table.view(np.int64)[mine["at"].to_numpy()] |= mine["bits"].to_numpy()
    return rows.num_rows > 0


def counts(docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, n, phrase, total): all phrases of 1 to 3 words with ``threshold`` occurrences in their language, and n = 0, its words; written."""
    if not 1 <= shards <= 4:
        raise ValueError("1 to 4 shards: scans of reaching have to fit eight bits")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = written(rows.withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(shards)).cast("int")), "shards", ("shard",))
    state, activity, last = spark.createDataFrame([], "key string, packed long"), Activity(bits), -1
    for scan in range(3 * shards):
        shard, shared = scan % shards, spark.sparkContext.broadcast(activity)
        new = scanned(rows.where(F.col("shard") == shard), scan, shards, shared)
        both = state.withColumn("count", F.lit(0).cast("long")).unionByName(new.withColumn("packed", F.lit(0).cast("long")))
        # A key has one row of the state at most, so the sum of packed values is that row's.
        both = both.groupBy("key").agg(F.sum("packed").alias("old"), F.sum("count").alias("count"))
        old, met = F.col("old"), 1 << (_REACH + shard)
        again = old.bitwiseAND(F.lit(met).cast("long")) != 0
        total = F.shiftright("old", _MET) + F.when(again, F.lit(0)).otherwise(F.col("count"))
        low = F.when(F.col("count") > 0, old.bitwiseOR(F.lit(met).cast("long"))).otherwise(old).bitwiseAND(F.lit((1 << _MET) - 1).cast("long"))
        reached = F.when((low.bitwiseAND((1 << _REACH) - 1) == 0) & (total >= threshold), F.lit(scan + 1)).otherwise(F.lit(0))
        both = both.select("key", (F.shiftleft(total, _MET) + low + reached).alias("packed"))
        state = written(_kept(both, scan, shards, threshold, shared), "counts")
        last = scan if _learn(state, scan, activity) else last
        shared.destroy()
        if scan >= max(shards - 1, last + shards):
            break
    phrase = F.substring_index("key", _BREAK, -1)
    lang = F.expr("substring(key, 1, length(key) - length(phrase) - 1)")
    found = state.withColumn("total", F.shiftright("packed", _MET)).withColumn("phrase", phrase).withColumn("lang", lang)
    n = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return found.where((F.col("phrase") == "") | (F.col("total") >= threshold)).select("lang", n.alias("n"), "phrase", "total")


def _head(column: str, n: int) -> Column:
    return F.substring_index(column, " ", n)


def candidates(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): frequent phrases that no longer one covers, with their weakest cut; written."""
    part = frequent.where("n between 1 and 2").select("lang", "phrase", "total")
    longer = frequent.where("n >= 2").withColumnRenamed("total", "a")
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
    two = F.array(cut(1, _head("phrase", 1), _head("phrase", -1)))
    three = F.array(cut(1, _head("phrase", 1), _head("phrase", -2)), cut(2, _head("phrase", 2), _head("phrase", -1)))
    rows = longer.select("lang", "n", "phrase", "a", F.explode(F.when(F.col("n") == 2, two).otherwise(three)).alias("cut")).select("lang", "n", "phrase", "a", "cut.*")
    for side, out in (("left", "l"), ("right", "r")):
        rows = rows.join(part.select("lang", F.col("phrase").alias(side), F.col("total").alias(out)), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    rows = rows.withColumn("up", wide("a") * wide("a") * F.lit(SCALE).cast("decimal(7,0)")).withColumn("down", wide("l") * wide("r"))
    rows = rows.withColumn("score", F.expr("up div down"))
    weakest = rows.groupBy("lang", "n", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w")).select("lang", "n", "phrase", "a", "w.l", "w.r", "w.score")
    inside = longer.where("n = 3").select("lang", F.explode(F.array(_head("phrase", 2), _head("phrase", -2))).alias("phrase"), F.col("a").alias("whole"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    left = weakest.join(inside, ["lang", "phrase"], "left").where(F.coalesce(F.col("whole") * 100 < F.col("a") * COVER, F.lit(True)))
    return written(left.select("lang", "phrase", "a", "l", "r", "score"), "candidates")


def collocations(docs: DataFrame, best: int = BEST, threshold: int = THRESHOLD, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` phrases of each language.

    A null language is ``und``.  Null and empty texts have no words; repeated rows count
    each; doc_id does not matter, nor do other columns.  Equal scores go by count, then by
    phrase, so the result is the same in every run.  No frequent phrase, no row.
    """
    every = counts(docs, threshold, shards)
    found = candidates(every)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    # Each part keeps its best, so that no language stands in one task as a whole.
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts(docs.sparkSession))))
    found = found.withColumn("rank", place("lang", "part")).where(F.col("rank") <= best)
    found = found.withColumn("rank", place("lang")).where(F.col("rank") <= best)
    sizes = every.where("n = 0").select("lang", F.col("total").alias("n"))
    return found.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM piece),
f AS (SELECT lang, m, phrase, count(*) AS f FROM (
        SELECT lang, 1 AS m, unnest(ws) AS phrase FROM w
        UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
        UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w)
      GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND f >= 10),
cut AS (SELECT lang, m, phrase, f AS a, k, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:m], ' ') AS rest
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT cut.*, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.first JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rest),
weakest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(f) AS whole FROM (
             SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, f FROM c WHERE m = 3) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest LEFT JOIN inside USING (lang, phrase) JOIN n USING (lang)
WHERE whole IS NULL OR 100 * whole < 50 * a
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
