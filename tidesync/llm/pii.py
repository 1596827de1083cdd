"""Personal data: pattern spans, and terms that disclose them by corpus co-occurrence.

Base spans (email, ip, card, phone) come from regular expressions, with
checks on the numbers. Positions are sums of the lengths of what the pattern
splits and what it matches, so no Python is needed.

Information-theoretic part: what a term ``t`` tells about a protected entity
``e`` (one value of one kind) is their pointwise mutual information over the
corpus, log(n(e,t) N / (n(e) n(t))), as a share of what there is to tell,
log(N / n(e)). All four count distinct texts, so copies of a text count once
everywhere; n(e,t) counts those with ``t`` among the ``NEAR`` words on both
sides of ``e``. Near copies of one text are one piece of evidence: texts that
share a band of min-hashes of their 3-word shingles are of one copy class, and a
term must be met in ``MIN_CONTEXTS`` classes at least. A term whose share of the
information reaches ``GENERALISE`` is a span of
kind ``term`` wherever it occurs in the documents of that entity. ``sanitise``
replaces base spans by their kind, generalises such terms to what they are (a
name or a word), and removes those whose share reaches ``REMOVE``.

Only texts with entities are exploded entity by entity, once a text, and counts
are partial aggregates, so an entity in a third of all rows is reduced where it
is read. Text frequencies are aggregated before they meet the candidate terms,
and a text gets only those of its entities' terms whose longest run of letters
and digits it has, so nothing grows with texts times terms of an entity.

Defined cases: null text counts as empty, with no spans; very long texts are
searched whole (patterns are written without backtracking, so they cost time
in proportion to the text; taking spans apart and replacing them costs time in
proportion to the spans times the text); repeated rows each keep a row; null ids are kept;
an empty table gives an empty table; extra columns are kept by ``sanitise``
and ignored by ``personal_data``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import land, packed, table, unpacked

#: Kinds in order, and the pattern of each. Possessive loops match what the plain
#: ones do, in linear time; look-behinds only skip starts from which no leftmost match can come.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = "term"
NEAR = 4
MIN_CONTEXTS = 2
SHINGLE, BANDS, BAND = 3, 8, 3
GENERALISE, REMOVE = 0.75, 0.95
_CHUNK = 256


def _luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _spans(text: Column, pattern: Column, order: int, near: bool) -> Column:
    """Matches as array<struct<start, ord, end, value, near>>; positions in code points, end exclusive."""
    built = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))

    def measured(s: Column) -> Column:
        # end of hit i = all gaps and hits up to it: whole chunks first, then the rest of its chunk
        steps = F.zip_with(s["hits"], F.slice(s["gaps"], 1, F.size(s["hits"])), lambda h, g: F.length(h) + F.length(g))
        return F.struct(s["hits"].alias("hits"), s["gaps"].alias("gaps"), steps.alias("steps"), F.transform(
            F.sequence(F.lit(0), F.floor(F.size(s["hits"]) / _CHUNK).cast("int")), lambda c: _sum(F.slice(steps, c * _CHUNK + 1, _CHUNK))).alias("chunks"))

    def located(s: Column) -> Column:
        def one(hit: Column, i: Column) -> Column:
            chunk = F.floor(i / _CHUNK).cast("int")
            end = _sum(F.slice(s["chunks"], 1, chunk)) + _sum(F.slice(s["steps"], chunk * _CHUNK + 1, i % _CHUNK + 1))
            around = _near(s["gaps"][i], s["gaps"][i + 1]) if near else F.array().cast("array<string>")
            return F.struct((end - F.length(hit)).alias("start"), F.lit(order).alias("ord"), end.alias("end"), hit.alias("value"), around.alias("near"))

        return F.transform(s["hits"], one)

    found = F.transform(F.transform(F.array(built), measured), located)
    return F.flatten(found)


def _near(before: Column, after: Column) -> Column:
    words = lambda gap: F.filter(F.split(gap, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    left = words(before)
    return F.concat(F.slice(left, F.greatest(F.lit(1), F.size(left) - NEAR + 1), F.lit(NEAR)), F.slice(words(after), 1, NEAR))


_NONE = "array<struct<start:int,ord:int,end:int,value:string,near:array<string>>>"


def base_spans(text: Column, near: bool = False) -> Column:
    """All valid base spans of a text (not null), by start, then kind."""
    hint = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.contains("+")}
    found = [
        F.when(hint[k], _checked(k, _spans(text, F.lit(PATTERNS[k]), n, near))).otherwise(F.array().cast(_NONE))
        for n, k in enumerate(KINDS)
    ]
    return F.array_sort(F.concat(*found))


def located(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, base spans (with the words near them) and, where there are any, the text of every row, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text")).withColumn("spans", base_spans(F.col("text"), near=True))
    return land(rows.withColumn("text", F.when(F.size("spans") > 0, F.col("text"))), "pii-spans")


def marked(found: DataFrame) -> DataFrame:
    """digest, text and spans of the distinct texts that hold an entity."""
    return land(found.where(F.size("spans") > 0).select("digest", "text", "spans").dropDuplicates(["digest"]), "pii-marked")


def _bands(text: Column) -> Column:
    """Hashes of ``BAND`` min-hashes each, over the shingles of a text; x XOR c orders the hashes anew for every c."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, SHINGLE)]))
    least = lambda hs, k: F.array_min(F.transform(hs, lambda h: h.bitwiseXOR(F.xxhash64(F.lit(k)))))
    bands = lambda hs: F.array(*[F.xxhash64(F.lit(n), *[least(hs, n * BAND + k) for k in range(BAND)]) for n in range(BANDS)])
    return F.transform(F.transform(F.array(words), hashes), bands)[0]


def copy_classes(texts: DataFrame) -> DataFrame:
    """(digest, label) of the texts that share a band with another: the least digest at most two steps away."""
    keyed = land(texts.select("digest", F.explode(_bands(F.col("text"))).alias("band")), "pii-bands")
    heads = keyed.groupBy("band").agg(F.min("digest").alias("head"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    near = land(keyed.join(heads, "band").groupBy("digest").agg(F.min("head").alias("label")), "pii-near")
    keyed = keyed.join(near, "digest")
    heads = keyed.groupBy("band").agg(F.min("label").alias("head"))
    return land(keyed.join(heads, "band").groupBy("digest").agg(F.min("head").alias("label")), "pii-classes")


def _entities(texts: DataFrame) -> DataFrame:
    return texts.select("digest", F.explode("spans").alias("s")).select("digest", "s.ord", "s.value").distinct()


def _usable(term: Column) -> Column:
    return ~term.rlike(r"[0-9@]") & (F.length(term) > 2)


def disclosures(docs: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """(ord, value, term, share): terms whose share of the information about an entity reaches ``GENERALISE``."""
    bare = lambda w: F.regexp_replace(w, r"^[^\p{L}]+|[^\p{L}]+$", "")
    near = texts.select("digest", F.explode("spans").alias("s")).select("digest", "s.ord", "s.value", F.explode("s.near").alias("word"))
    near = near.select("digest", "ord", "value", bare(F.col("word")).alias("term")).where(_usable(F.col("term"))).distinct()
    near = near.join(copy_classes(texts), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    pairs = near.groupBy("ord", "value", "term", "label").agg(F.count("*").alias("n"))
    pairs = pairs.groupBy("ord", "value", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("classes")).where(F.col("classes") >= MIN_CONTEXTS)
    pairs = land(pairs.drop("classes"), "pii-pairs")
    n_texts = found.select("digest").distinct().count()
    n_e = _entities(texts).groupBy("ord", "value").agg(F.count("*").alias("n_e"))
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_distinct(F.transform(F.split("text", r"[\x20\x09-\x0D]+"), bare))
    every = docs.select(F.xxhash64(text).alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    n_t = every.select(F.explode(words).alias("term")).where(_usable(F.col("term"))).groupBy("term").agg(F.count("*").alias("n_t"))
    counted = pairs.join(n_e, ["ord", "value"]).where(F.col("n_e") < n_texts).join(n_t, "term", "left")
    n_t = F.greatest("n_t", "n_et")  # a word glued to an entity is near it, but no word of the text
    told = F.log(F.col("n_et") * F.lit(float(n_texts)) / (F.col("n_e") * n_t)) / F.log(F.lit(float(n_texts)) / F.col("n_e"))
    return land(counted.select("ord", "value", "term", told.alias("share")).where(F.col("share") >= GENERALISE), "pii-terms")


def _term_lists(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(t_digest, terms) of the texts that hold an entity and may hold terms that disclose it."""
    runs = lambda c: F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    longest = F.array_max(F.transform(runs(F.col("term")), lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))["run"]
    held = texts.select("digest", F.explode(F.array_distinct(runs(F.col("text")))).alias("run"))
    met = held.join(terms.withColumn("run", longest), "run").join(_entities(texts), ["digest", "ord", "value"])
    listed = met.groupBy("digest", "term").agg(F.max("share").alias("share"))
    return land(listed.groupBy(F.col("digest").alias("t_digest")).agg(F.sort_array(F.collect_list(F.struct("term", "share"))).alias("t_terms")), "pii-lists")


def _term_spans(text: Column, terms: Column) -> Column:
    quoted = F.transform(terms, lambda t: F.regexp_replace(t["term"], r"([^\p{L}\p{N}])", r"\\$1"))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    return F.when(F.size(terms) > 0, _spans(text, pattern, len(KINDS), False)).otherwise(F.array().cast(_NONE))


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["ord"]], s["start"], s["end"])), ",")


def _counted(spans: Column, order: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["ord"] == order)).cast("long")


def _apart(spans: Column, base: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, and all spans, of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = located(docs)
    texts = marked(found)
    lists = _term_lists(texts, disclosures(docs, found, texts))
    extra = texts.join(lists, F.col("digest") == F.col("t_digest")).select("t_digest", _term_spans(F.col("text"), F.col("t_terms")).alias("extra"))
    rows = found.drop("text").join(extra, F.col("digest") == F.col("t_digest"), "left")
    every = F.array_sort(F.concat("spans", _apart(F.coalesce("extra", F.array().cast(_NONE)), F.col("spans"))))
    counts = [_counted(F.col("spans"), n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_written(F.col("spans")).cast("binary"), 256).alias("base_sha256"), _written(every).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (and ``n_chars`` to match); null texts stay null."""
    rows = packed(docs)
    plain = rows.select("doc_id", "text")
    found = located(plain)
    texts = marked(found)
    lists = _term_lists(texts, disclosures(plain, found, texts))
    rows = rows.join(lists, F.xxhash64("text") == F.col("t_digest"), "left")
    rows = rows.withColumn("terms", F.coalesce("t_terms", F.array().cast("array<struct<term:string,share:double>>")))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    spans = F.array_sort(F.concat("base", _apart(_term_spans(F.col("text"), F.col("terms")), F.col("base"))))
    rows = rows.withColumn("spans", spans)
    rows = rows.withColumn("cleaned", F.when(F.size("spans") > 0, _redacted(F.col("text"), F.col("spans"), F.col("terms"))).otherwise(F.col("row").getField("text")))
    return unpacked(rows, docs.columns, {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")})


def _redacted(text: Column, spans: Column, terms: Column) -> Column:
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def tag(s: Column) -> Column:
        share = F.array_max(F.transform(F.filter(terms, lambda t: t["term"] == s["value"]), lambda t: t["share"]))
        general = F.when(s["value"].rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[WORD]"))
        return F.when(s["ord"] < len(KINDS), tags[s["ord"]]).otherwise(F.when(share >= REMOVE, F.lit("")).otherwise(general))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]  # of overlapping spans the first one's tag stands for both
        kept = F.when(fresh, F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), tag(s))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), kept.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return personal_data(table(spark, sf_dir, "documents"))
