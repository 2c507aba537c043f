"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text's fingerprint keeps the smallest 5-gram hash of every 6 consecutive 5-grams, with
its place.  Six 5-grams are ten words, so two texts that share ten consecutive words
share a fingerprint at the same place of those words: no shared window is missed.  Test
fingerprints are joined with those of the documents; each hit is extended to the ten-word
windows around it, which are then compared word by word through a digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgersieve.llm.store import ascii_lower, parted, text_key, without, written

GRAM, GRAMS = 5, 6
WINDOW = GRAM + GRAMS - 1
#: Low bits of a packed fingerprint hold the place, the 33 above them the hash.
PLACE_BITS = 30
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Words of a text: letters, digits and all beyond ASCII; A-Z lower-cased; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def _after(name: str, k: int) -> Column:
    """The array column without its first ``k`` entries."""
    return F.slice(name, F.lit(k + 1), F.size(name))


def fingerprints(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``: packed (hash, place) of the winnowed 5-grams of the array ``words``.

    Fewer than ten words have no fingerprint.
    """
    pair = lambda a, b: F.xxhash64(a, b)
    low = lambda a, b: F.least(a, b)
    df = df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_h2", F.zip_with("_h1", _after("_h1", 1), pair))
    df = df.withColumn("_h4", F.zip_with("_h2", _after("_h2", 2), pair))
    df = df.withColumn("_g", F.slice(F.zip_with("_h4", _after("_h1", 4), pair), F.lit(1),
                                     F.greatest(F.size(words) - (GRAM - 1), F.lit(0))))
    df = df.withColumn("_p", F.transform("_g", lambda x, i: F.shiftleft(
        F.shiftrightunsigned(x, PLACE_BITS + 1), PLACE_BITS).bitwiseOR(i.cast("long"))))
    df = df.withColumn("_m2", F.zip_with("_p", _after("_p", 1), low))
    df = df.withColumn("_m4", F.zip_with("_m2", _after("_m2", 2), low))
    least = F.slice(F.zip_with("_m4", _after("_m2", 4), low), F.lit(1),
                    F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    return df.withColumn(out, F.array_distinct(least)).drop("_h1", "_h2", "_h4", "_g", "_p", "_m2", "_m4")


def _place(packed: Column) -> Column:
    return packed.bitwiseAND((1 << PLACE_BITS) - 1).cast("int")


def _digest(words: str, start: Column, length: Column) -> Column:
    return F.md5(F.array_join(F.slice(words, start + 1, length), " "))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, m, digest): distinct windows of each item, ``m`` words long.

    An item of fewer than ten words is one window, one without words has none.  A null
    item_id reads as an empty one.
    """
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                         word_list(F.col("text")).alias("words"))
    n = F.size("words")
    spans = words.where(n > 0).withColumn("m", F.least(n, F.lit(WINDOW))).withColumn(
        "s", F.explode(F.sequence(F.lit(0), n - F.least(n, F.lit(WINDOW)))))
    return spans.select("item_id", "m", _digest("words", F.col("s"), F.col("m")).alias("digest")).distinct()


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the document's words that lie in an occurrence of an item's window.
    Null and empty texts have no words and are clean; null doc_ids are allowed; repeated
    rows have a row each; items without words are ignored, items that repeat an id count
    once; no item at all leaves every document clean.  Other columns are left aside.
    """
    return _contamination(docs, items).drop("key")


def _contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("key", text_key())
    marked = fingerprints(source.withColumn("words", word_list(F.col("text"))), "words", "prints")
    marked = written(marked.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), "prints"), "prints")

    windows = written(item_windows(items), "windows")
    item_words = items.select(word_list(F.col("text")).alias("words"))
    tests = fingerprints(item_words.where(F.size("words") >= WINDOW), "words", "prints")
    tests = written(tests.select(F.explode("prints").alias("p")).select(F.shiftright("p", PLACE_BITS).alias("gram")).distinct(), "tests")

    hits = (marked.select("doc_id", "key", "n_words", F.explode("prints").alias("p"))
            .withColumn("gram", F.shiftright("p", PLACE_BITS)).join(tests, "gram", "left_semi"))
    first, last = F.greatest(_place(F.col("p")) - (GRAMS - 1), F.lit(0)), F.least(
        _place(F.col("p")), F.col("n_words").cast("int") - WINDOW)
    spans = hits.select("doc_id", "key", F.explode(F.sequence(first, last)).alias("s"), F.lit(WINDOW).alias("m"))

    short = item_words.where((F.size("words") > 0) & (F.size("words") < WINDOW)).select(
        F.col("words")[0].alias("word"), F.size("words").alias("m")).distinct()
    if not short.isEmpty():
        placed = source.select("doc_id", "key", F.posexplode(word_list(F.col("text"))).alias("s", "word"))
        spans = spans.unionByName(placed.join(short, "word").select("doc_id", "key", "s", "m"))

    # A set of places in one text: no longer than ten times the text.
    spans = written(spans.groupBy("doc_id", "key").agg(F.collect_set(F.struct("s", "m")).alias("spans")), "spans")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["key"] == b["key"])
    maybe, _ = parted(source, spans)
    texts = maybe.join(spans, same(maybe, spans)).select(maybe["doc_id"], maybe["key"], "text", "spans")
    texts = texts.withColumn("words", word_list(F.col("text")))
    tried = texts.select("doc_id", "key", F.explode(F.transform("spans", lambda x: F.struct(
        x["s"].alias("s"), x["m"].alias("m"), _digest("words", x["s"], x["m"]).alias("digest")))).alias("x")).select(
        "doc_id", "key", "x.*")
    found = written(tried.join(windows.select("m", "digest").distinct(), ["m", "digest"], "left_semi"), "found")

    covered = found.groupBy("doc_id", "key").agg(F.size(F.array_distinct(F.flatten(F.collect_list(
        F.sequence(F.col("s"), F.col("s") + F.col("m") - 1))))).cast("long").alias("n_hit"))
    named = (found.select("doc_id", "key", "m", "digest").distinct().join(windows, ["m", "digest"])
             .select("doc_id", "key", "item_id").distinct()
             .groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_items"),
                                           F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("ids")))
    both = covered.join(named, same(covered, named)).select(covered["doc_id"], covered["key"], "n_hit", "n_items", "ids")
    out = marked.select("doc_id", "key", "n_words")
    return out.join(both, same(out, both), "left").select(
        out["doc_id"], out["key"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def kept(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no window of any item, with all their columns."""
    return without(docs, _contamination(docs, items).where("contaminated"))


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') AS win
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS s FROM i WHERE len(ws) > 0)),
dw AS (SELECT doc_id, m, s, array_to_string(ws[s:s + m - 1], ' ') AS win
       FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS s
             FROM w, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)),
hit AS (SELECT DISTINCT doc_id, m, s, win FROM dw SEMI JOIN iw USING (m, win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit JOIN iw USING (m, win)) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN cover USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
