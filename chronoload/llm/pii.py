"""Personal data: patterns, and information-theoretic sanitisation of the terms that give it away.

Built from DataFrame functions alone. The base patterns find e-mail addresses, IP numbers, cards and phones; each value
found is a protected entity. A term is a word of three letters or more that stands in a document with an entity,
wherever. Over all documents, with N documents, n(c) and n(t) of them holding entity c and term t, and n(c, t) holding
both, the term discloses

    PMI(c; t) = log2(N * n(c, t) / (n(c) * n(t)))   of the   IC(c) = log2(N / n(c))

bits that the entity is worth. In the documents that hold c, every place of a term that shares ``SUPPORT`` documents or
more with it is removed if the term discloses ``REMOVE`` of IC(c) or more, and generalised if it discloses ``GENERALISE``
of it. What stands in a base span is no term.

Terms are counted in each document, then summed before they are shuffled, so a word of a third of all documents is one row
a task. Terms and entities of a document meet by its row, after those are left out that can reach neither the support
nor, as n(c, t) is n(c) at most, the least share: n(t) <= N^(1 - share) * n(c)^share. Nothing that could count is lost.

Patterns start only where a match can start and never give back what they took, which finds the same matches as the
plain patterns in time linear in the text. Defined results: a null or empty text has no span; matches that fail their
test are dropped without another try; equal spans of repeated rows are found in each; words that touch a base span are
no terms; an empty table gives an empty result; other columns are carried by ``sanitise`` and ignored by the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoload.llm.common import keyed_texts, table
from chronoload.session import prepare, stage

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
SUPPORT = 3
REMOVE = 0.9
GENERALISE = 0.75
_IP = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
_WORD = r"(?<![\p{L}\p{N}])\p{L}{3,}(?![\p{L}\p{N}])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total, i):
        d = F.substring(turned, i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _good(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(_IP)
    n = F.length(_digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)


def _may(kind: str, text: Column) -> Column:
    """A cheap sign without which the pattern can't match."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    return F.contains(text, F.lit("+")) if kind == "phone" else text.rlike("[0-9]")


_SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def _spans(text: Column, kind: str) -> Column:
    """All matches of a kind with their places in code points."""
    number = KINDS.index(kind)
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    parts = F.zip_with(found, F.slice(gaps, 2, F.size(found)), lambda v, after: F.struct(v.alias("v"), after.alias("g")))
    empty = F.array().cast(f"array<{_SPAN}>")

    def step(state, x):
        start = state["at"]
        end = start + F.char_length(x["v"])
        span = F.struct(
            start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), x["v"].alias("value"))
        keep = _good(kind, x["v"])
        return F.struct(
            (end + F.char_length(x["g"])).alias("at"),
            F.when(keep, F.concat(state["out"], F.array(span).cast(f"array<{_SPAN}>"))).otherwise(state["out"]).alias("out"))

    first = F.element_at(gaps, 1)
    state = F.struct(F.char_length(first).cast("bigint").alias("at"), empty.alias("out"))
    return F.when(_may(kind, text), F.aggregate(parts, state, step, lambda s: s["out"])).otherwise(empty)


def base_spans(docs: DataFrame) -> DataFrame:
    """``_row, doc_id, base, bare``: the base spans of every document, by start and kind; where there are any, the text
    with a 0 for each of their characters, which leaves places as they are and joins no words."""
    rows = keyed_texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    found = rows.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", "text",
        F.array_sort(F.concat(*[_spans(F.col("text"), k) for k in KINDS])).alias("base"))

    def step(state, s):
        begin, end = F.greatest(state["at"], s["start"]), F.greatest(state["at"], s["end"])
        piece = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (begin - state["at"]).cast("int"))
        return F.struct(end.alias("at"), F.concat(state["out"], piece, F.repeat(F.lit("0"), (end - begin).cast("int"))).alias("out"))

    bare = F.aggregate("base", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return found.select("_row", "doc_id", "base", F.when(F.size("base") > 0, bare).alias("bare"))


def held_entities(found: DataFrame) -> DataFrame:
    """``_row, entity``: the distinct entities of each document."""
    names = F.transform("base", lambda s: F.concat_ws(":", s["kind"].cast("string"), F.lower(s["value"])))
    return found.where(F.size("base") > 0).select("_row", F.explode(F.array_distinct(names)).alias("entity"))


def held_terms(found: DataFrame) -> DataFrame:
    """``_row, term``: the distinct words of each document that holds an entity, outside its base spans."""
    words = F.transform(F.regexp_extract_all("bare", F.lit(_WORD), F.lit(0)), F.lower)
    return found.where("bare is not null").select("_row", F.explode(F.array_distinct(words)).alias("term"))


def term_places(found: DataFrame) -> DataFrame:
    """``_row, term, start, end``: every place of the words of ``held_terms``, by running lengths."""
    words = F.regexp_extract_all("bare", F.lit(_WORD), F.lit(0))
    pairs = F.zip_with(words, F.slice(F.split("bare", _WORD, -1), 1, F.size(words)),
                       lambda v, g: F.struct(v.alias("v"), (F.char_length(g) + F.char_length(v)).alias("n")))
    each = found.where("bare is not null").select("_row", F.posexplode(pairs).alias("k", "x"))
    end = F.sum("x.n").over(Window.partitionBy("_row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    return each.select("_row", F.lower("x.v").alias("term"), end.alias("end"), F.char_length("x.v").alias("n")).select(
        "_row", "term", (F.col("end") - F.col("n")).alias("start"), "end")


def term_counts(docs: DataFrame) -> DataFrame:
    """``term, n_term``: in how many documents each word of three letters or more stands."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    each = keyed_texts(docs).where("text is not null").select(F.explode(words).alias("term"))
    return each.where(F.char_length("term") >= 3).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosures(docs: DataFrame, found: DataFrame, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """``entity, term, share``: how much of the entity's information each supported term discloses, from ``least`` on."""
    total = float(docs.count())
    entities = held_entities(found).groupBy("entity").agg(F.count("*").alias("n_entity"))
    entities = stage(entities.where((F.col("n_entity") >= support) & (F.col("n_entity") < total)), "pii-entities")
    most = entities.agg(F.max("n_entity")).first()[0] or 0

    def limit(n):  # of n(t), for a share of ``least``; a little more for rounding
        return F.pow(F.lit(total), F.lit(1 - least)) * F.pow(n, F.lit(least)) * 1.000001

    terms = term_counts(docs).where((F.col("n_term") >= support) & (F.col("n_term") <= limit(F.lit(float(most)))))
    holds = held_entities(found).join(entities, "entity")
    words = held_terms(found.join(holds.select("_row").distinct(), "_row", "left_semi")).join(stage(terms, "pii-terms"), "term")
    both = holds.join(words, "_row").where(F.col("n_term") <= limit(F.col("n_entity").cast("double")))
    # A document comes in once a pair: what it repeats is counted once.
    pairs = both.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both"))
    bits = F.log2(F.lit(total) * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    worth = F.log2(F.lit(total) / F.col("n_entity"))
    return pairs.where(F.col("n_both") >= support).select(
        "entity", "term", (bits / worth).alias("share")).where(F.col("share") >= least)


def find_personal_data(
    docs: DataFrame, support: int = SUPPORT, remove: float = REMOVE, generalise: float = GENERALISE
) -> DataFrame:
    """``_row, doc_id, base, terms``: base spans, and spans of disclosing terms as (start, kind, end, remove)."""
    prepare(docs.sparkSession)
    found = stage(base_spans(docs), "pii-base")
    shares = stage(disclosures(docs, found, support, generalise), "pii-disclosures")
    told = held_entities(found).join(shares, "entity").groupBy("_row", "term").agg(F.max("share").alias("share"))
    told = stage(told, "pii-told")
    places = term_places(found.join(told.select("_row").distinct(), "_row", "left_semi"))
    told = places.join(told, ["_row", "term"])
    told = told.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("kind"), "end", (F.col("share") >= remove).alias("remove")))).alias("told"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,remove:boolean>>")
    return found.join(told, "_row", "left").select("_row", "doc_id", "base", F.coalesce("told", empty).alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def personal_data_report(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, and all spans as text."""
    found = find_personal_data(docs, **settings)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in range(len(KINDS))]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{name}") for n, name in zip(counts, KINDS, strict=True)]
    every = F.array_sort(F.concat(_bare(F.col("base")), _bare(F.col("terms"))))
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(every).alias("spans"))


def sanitise(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with all its columns; in ``text`` base spans read ``[kind]``, generalised terms ``[term]``, and removed
    terms are gone. Where spans overlap the first decides, and the others lose what it covers.

    Rows are matched by doc_id and text, so equal rows are treated alike.
    """
    rows = keyed_texts(docs).select("doc_id", "text").distinct()
    rows = stage(rows, "pii-rows")
    names = F.array(*[F.lit(f"[{k}]") for k in (*KINDS, TERM)])
    found = find_personal_data(rows, **settings)
    every = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                               F.lit(False).alias("remove"))), "terms"))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())

    def step(state, s):
        begin = F.greatest(state["at"], s["start"])
        piece = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (begin - state["at"]).cast("int"))
        mark = F.when(s["remove"] | (s["start"] < state["at"]), F.lit("")).otherwise(F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], piece, mark).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step,
                        lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    done = numbered.join(found.select("_row", every.alias("spans")), "_row").where("size(spans) > 0").select(
        F.col("doc_id").alias("_pii_id"), F.col("text").alias("_pii_text"), clean.alias("_pii_clean"))
    same = docs["doc_id"].eqNullSafe(F.col("_pii_id")) & (docs["text"] == F.col("_pii_text"))
    return docs.join(done, same, "left").withColumn("text", F.coalesce("_pii_clean", docs["text"])).drop(
        "_pii_id", "_pii_text", "_pii_clean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))
