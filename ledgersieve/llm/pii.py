"""Personal data: base patterns, and candidates ranked by gradient-boosted trees.

Base spans (e-mail, IP address, card, phone) follow fixed patterns and checks and always
stay.  High-recall generators propose further spans, which may overlap: words around an
``@``, dotted numbers, runs of digits with signs between, long mixed tokens.  Boosted
trees score a candidate by its format and the text around it; their labels are weak
(a word such as ``call``, ``mail`` or ``host`` stands before it, or its digits are grouped
as is agreed for phones and cards; for tokens, a word such as ``token`` or ``key`` is
assigned).  No label looks at base spans, and candidates that begin one are neither
learnt from nor scored, as they stay anyway.  The words are no feature.  A threshold for each kind is calibrated on candidates held out from training.

Only DataFrame functions and the JVM's tree learner are used.  Regular expressions give
matches without places, so a match carries the length of the gap before it, and a running
sum per text over matches alone gives the places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgersieve.llm.store import parted, text_key, written

KINDS = ("email", "ip", "card", "phone", "secret")

# Patterns.  Runs are possessive and begin where a run begins, so a long run
# that matches nothing is read once; the matches are those of the plain patterns.
_MAIL = "A-Za-z0-9._%+-"
_SEP = r"[\x20-]"
BASE = {
    "email": rf"(?:(?<![{_MAIL}])|\G)[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": rf"(?<![0-9])(?<![0-9]{_SEP})[0-9](?:{_SEP}?[0-9]){{15,18}}(?!{_SEP}?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = {
    "email": r"""(?<![^\s@<>"',;:])[^\s@<>"',;:]++@[^\s@<>"',;:]{2,}+""",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,4}(?![0-9])",
    "number": r"(?<![0-9A-Za-z])\+?[0-9(][0-9().\x20/-]{5,30}[0-9](?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_SECRET_WORDS = r"""(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|key)["']?\s*[=:]\s*["']?$"""
#: Words before a candidate, with at most a few signs between, that say what it is.
_CUE = {k: rf"(?i)(?<![a-z])(?:{w})(?![a-z])[^0-9a-z\n]{{0,6}}(?:(?:is|at|us|me|no|number|address)(?![a-z])[^0-9a-z\n]{{0,4}}){{0,2}}$" for k, w in {
    "email": "e-?mails?|mail|mailto|contact|write", "ip": "ip|ipv4|host|server|ping|gateway|dns|addr",
    "phone": "call|calls|tel|telephone|phone|mobile|cell|fax|dial|whatsapp|sms", "card": "card|visa|mastercard|amex|debit|credit"}.items()}
#: Agreed groups of digits: 3-3-4 with or without a country's number, and those printed on cards.
_GROUPED = {
    "phone": r"^(?:\+?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}$",
    "card": r"^[0-9]{4}([\x20./-])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{6}\1[0-9]{5})$"}
CONTEXT = 32

#: Bounds of training: candidates (thinned by a hash beyond that, each kind and label for itself), trees and depth.
MAX_CANDIDATES, TREES, DEPTH = 20_000, 10, 3
#: Precision on held-out candidates that a kind's threshold has to reach.
PRECISION = 0.9


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, source, kind, start, end, found, before, after): all pattern matches.

    Places are code points, end exclusive.  ``source`` is base or candidate.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), _text().alias("text"))
    digit = F.col("text").rlike("[0-9]")
    needs = {"email": F.instr("text", "@") > 0, "phone": F.instr("text", "+") > 0}
    none = F.array().cast("array<string>")
    names = [("base", k, p) for k, p in BASE.items()] + [("candidate", k, p) for k, p in CANDIDATE.items()]
    rows = rows.where(digit | needs["email"])
    for n, (_, kind, pattern) in enumerate(names):
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        rows = rows.withColumn(f"m{n}", F.when(needs.get(kind, digit), found).otherwise(none))
    for n, (_, _, pattern) in enumerate(names):
        rows = rows.withColumn(f"g{n}", F.when(F.size(f"m{n}") > 0, F.split("text", pattern, -1)).otherwise(none))

    def listed(n, source, kind):
        gap = F.col(f"g{n}")
        return F.transform(F.col(f"m{n}"), lambda m, i: F.struct(
            F.lit(source).alias("source"), F.lit(kind).alias("kind"), i.alias("i"),
            F.length(gap[i]).cast("long").alias("gap"), m.alias("found"),
            F.right(gap[i], F.lit(CONTEXT)).alias("before"), F.left(gap[i + 1], F.lit(CONTEXT)).alias("after")))

    rows = rows.select("doc_id", "key", F.explode(F.concat(*(listed(n, s, k) for n, (s, k, _) in enumerate(names)))).alias("x"))
    rows = written(rows.select("doc_id", "key", "x.*"), "matches").dropDuplicates(["doc_id", "key", "source", "kind", "i"])
    order = Window.partitionBy("doc_id", "key", "source", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(order))
    return rows.withColumn("start", F.col("end") - F.length("found")).drop("i", "gap")


def _digits(column: str = "found") -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def valid() -> Column:
    """Whether a base match passes the check of its kind."""
    n = F.length(_digits())
    return (F.when(F.col("kind") == "ip", F.col("found").rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(F.col("kind") == "card", F.call_function("luhn_check", _digits()))
            .when(F.col("kind") == "phone", n.between(8, 15)).otherwise(F.lit(True)))


def _features() -> dict[str, Column]:
    found, before, after = F.col("found"), F.col("before"), F.col("after")
    n = F.length("found")
    share = lambda sign: F.length(F.regexp_replace("found", f"[^{sign}]", "")) / n
    yes = lambda c: c.cast("double")
    return {
        "length": n.cast("double"), "digits": share("0-9"), "letters": share("A-Za-z"), "upper": share("A-Z"),
        "hex": share("0-9a-f"), "dots": share("."), "signs": share(r"\x20()/-"),
        "groups": F.size(F.split(found, "[^0-9A-Za-z]+")).cast("double"),
        "plus": yes(found.startswith("+")), "bracket": yes(found.contains("(")), "at": yes(found.contains("@")),
        "dot_after_at": yes(found.rlike(r"@[^.]+\.[A-Za-z]{2,}")),
        "one_sign": F.size(F.array_distinct(F.split(F.regexp_replace(found, "[0-9A-Za-z]", ""), ""))).cast("double"),
        "quote_before": yes(before.rlike("[\"']$")),
        # Signs after a cue would give the label of formats away.
        "sign_before": yes((F.col("kind") == "secret") & before.rlike(r"[=:]\s*[\"']?$")),
        "quote_after": yes(after.rlike("^[\"']")), "space_before": yes(before.rlike(r"(?:^|\s)$")),
        "space_after": yes(after.rlike(r"^(?:\s|$)")), "version_before": yes(before.rlike(r"(?i)(?:version|v\.?|by|nc)\s*$")),
        "digit_near": yes(before.rlike(r"[0-9]\s*$") | after.rlike(r"^\s*[0-9]")),
        **{f"is_{k}": yes(F.col("kind") == k) for k in CANDIDATE},
    }


def _kind() -> Column:
    """The kind a candidate counts as."""
    return F.when(F.col("kind") != "number", F.col("kind")).when(
        F.col("found").startswith("+") | (F.length(_digits()) <= 12), "phone").otherwise("card")


def _known() -> Column:
    """The weak label of a candidate, from its cue or its groups of digits."""
    cue = lambda kind: F.col("before").rlike(_CUE[kind])
    grouped = lambda kind: F.col("found").rlike(_GROUPED[kind])
    n, kind = F.length(_digits()), _kind()
    return (F.when(kind == "secret", F.col("before").rlike(_SECRET_WORDS)).when(kind == "email", cue("email")).when(kind == "ip", cue("ip"))
            .when(kind == "phone", n.between(7, 15) & (cue("phone") | grouped("phone")))
            .otherwise(n.between(13, 19) & (cue("card") | grouped("card")) & F.call_function("luhn_check", _digits())))


def candidates(found: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates with their features, weak label and place, written."""
    mixed = (F.col("kind") != "secret") | (F.col("found").rlike("[0-9]") & F.col("found").rlike("[A-Za-z]"))
    rows = found.where((F.col("source") == "candidate") & mixed)
    starts = base.select(F.col("doc_id").alias("b_id"), F.col("key").alias("b_key"), F.col("start").alias("b_start")).distinct()
    rows = rows.join(starts, rows["doc_id"].eqNullSafe(F.col("b_id")) & (rows["key"] == F.col("b_key"))
                     & (rows["start"] == F.col("b_start")), "left")
    return written(rows.select("doc_id", "key", _kind().alias("as"), "start", "end", F.col("b_start").isNotNull().alias("is_base"),
                               _known().cast("double").alias("label"), F.xxhash64("found", "before", "after").alias("h"),
                               *(c.alias(f"f_{k}") for k, c in _features().items())), "candidates")


def added(rows: DataFrame, precision: float = PRECISION, max_candidates: int = MAX_CANDIDATES) -> DataFrame | None:
    """(doc_id, key, kind, start, end) of candidates above their kind's threshold, base spans left out.

    None if the candidates have only one label, so that nothing can be learnt.
    """
    rows = rows.where(~F.col("is_base"))
    counts = {(r["as"], r["label"]): r["n"] for r in rows.groupBy("as", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len({label for _, label in counts}) < 2:
        return None
    inputs = [c for c in rows.columns if c.startswith("f_")]
    rows = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows).drop(*inputs)
    fold = F.pmod(F.xxhash64("h", F.lit(7)), F.lit(5))
    part = rows
    if sum(counts.values()) > max_candidates:
        # Each kind and label has an equal share of the bound, so that a rare kind is learnt beside millions of others.
        share = max_candidates / len(counts)
        bound = reduce(lambda a, c: a.when((F.col("as") == c[0]) & (F.col("label") == c[1]), int(min(1, share / counts[c]) * (1 << 20))), counts, F)
        part = rows.where(F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 20)) < bound)
    learn = written(part.where(fold != 0).select("features", "label"), "learn")
    if learn.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1).fit(learn)
    score = vector_to_array("probability")[1]
    # Only the fit is bounded; the thresholds come from all candidates held out from it.
    seen = model.transform(rows.where(fold == 0)).select("as", F.floor(score * 100).alias("bin"), "label")
    table = seen.groupBy("as", "bin").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")).collect()
    least = {}
    for kind in KINDS:
        yes = n = 0
        for r in sorted((r for r in table if r["as"] == kind), key=lambda r: -r["bin"]):
            yes, n = yes + r["yes"], n + r["n"]
            if yes >= precision * n:
                least[kind] = r["bin"] / 100
    if not least:
        return None
    enough = reduce(lambda a, b: a | b, ((F.col("as") == k) & (F.col("score") >= v) for k, v in least.items()))
    scored = model.transform(rows).withColumn("score", score)
    return scored.where(enough).select("doc_id", "key", F.col("as").alias("kind"), "start", "end")


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kind, start, end, base): base spans and the added ones, written."""
    found = written(matches(docs), "found")
    base = found.where((F.col("source") == "base") & valid()).select("doc_id", "key", "kind", "start", "end")
    more = added(candidates(found, base))
    every = base.withColumn("base", F.lit(True))
    if more is not None:
        every = every.unionByName(more.withColumn("base", F.lit(False)))
    return written(every.groupBy("doc_id", "key", "kind", "start", "end").agg(F.max("base").alias("base")), "spans")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256 (of kind:start:end), spans (all spans, written likewise), n_added (spans beside the base ones).

    A null text reads as an empty one and has no spans; null doc_ids are allowed; repeated
    rows have a row each; spans of one text may overlap.  Other columns are left aside.
    """
    every = spans(docs)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct(order.alias("o"), "start", "end", "kind", "base")
    text = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    listed = every.groupBy("doc_id", "key").agg(
        *(F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS[:4]),
        F.array_sort(F.collect_list(entry)).alias("all"))
    listed = listed.select(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key"), *(f"n_{k}" for k in KINDS[:4]),
                           F.array_join(F.transform(F.filter("all", lambda x: x["base"]), text), ",").alias("base"),
                           F.array_join(F.transform("all", text), ",").alias("spans"),
                           F.size(F.filter("all", lambda x: ~x["base"])).alias("n_added"))
    rows = _keyed(docs)
    out = rows.join(listed, rows["doc_id"].eqNullSafe(listed["s_id"]) & (rows["key"] == listed["s_key"]), "left")
    return out.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
                      F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_added", F.lit(0)).cast("long").alias("n_added"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Overlapping spans become one, named by the first.  ``n_chars``, if there, follows the
    new text.  All other columns and all rows stay.
    """
    every = spans(docs)
    before = Window.partitionBy("doc_id", "key").orderBy("start", "end", "kind")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    block = F.sum((F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")).over(before)
    merged = (every.withColumn("block", block).groupBy("doc_id", "key", "block").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind")))
    merged = merged.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    merged = written(merged.select(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key"), "cuts"), "cuts")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"))
    rows, never = parted(rows, merged.select(F.col("s_key").alias("key")))
    rows = rows.join(merged, rows["doc_id"].eqNullSafe(merged["s_id"]) & (rows["key"] == merged["s_key"]), "left")
    text = F.col("row")["text"].cast("string")
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    cuts = F.col("cuts")
    begin = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(cuts, F.greatest(i, F.lit(1)))["end"])
    pieces = F.transform(cuts, lambda c, i: F.concat(part(begin(i), c["start"]), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    tail = part(F.element_at(cuts, -1)["end"], F.length(text).cast("long"))
    new = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    rows = rows.withColumn("new", new)
    kinds = dict(docs.dtypes)

    def column(c):
        if c == "text":
            return F.col("new").alias(c)
        if c == "n_chars":
            return F.when(F.col("cuts").isNull(), F.col("row")[c]).otherwise(F.length("new")).cast(kinds[c]).alias(c)
        return F.col("row")[c].alias(c)

    return rows.select(*(column(c) for c in docs.columns)).unionByName(never.select("row.*"))
