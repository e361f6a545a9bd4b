"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms around them.

Base spans are emails, ip addresses, cards and phones by pattern and check. Each value found is a protected
entity. The words of a text outside its base spans are candidate terms of the entities in it, and the corpus tells
how strongly a term reveals an entity: with N different texts, and those that hold the term, the entity and both,

    disclosure = ln(N * n(term, entity) / (n(term) * n(entity))) / ln(N / n(entity)),

the share of the entity's information content that the term carries. Terms with a disclosure of at least
``GENERALISE`` are generalised (replaced by a placeholder), from ``REMOVE`` on they are taken out, everywhere in
the documents that hold the entity.

A term must also be beside the entity more often than chance explains. The ``WINDOW`` code points on both sides of
the entity's first place in a text are its context there, and copies and near copies with equal contexts count once.
Of n contexts k are in texts with the term; by Hoeffding's bound chance gives as many with a probability of at most
exp(-n * KL(k / n, n(term) / N)), and this times the number of pairs tested must not exceed ``CHANCE``. An entity
with one context is not tested: the words of one text depend on each other, so it proves nothing.

Everything runs on built-in functions. The patterns are written so that a match is searched once per run of
characters, without changing what the plain ones find.

Defined results: a null text is an empty one and has no spans. Positions are code points, ends exclusive. Spans
of different kinds may overlap; in the sanitised text overlapping spans become one placeholder. Repeated rows give
repeated results; a null doc_id gets its base spans but no term spans; other columns are ignored by
``personal_data`` and kept by ``sanitised``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table, written

KINDS = ("email", "ip", "card", "phone")
WINDOW, CHANCE, GENERALISE, REMOVE = 100, 0.05, 0.8, 0.95

_LOCAL = "[A-Za-z0-9._%+-]"
#: leftmost matches of the plain patterns; possessive and anchored to the start of a run, or to the last match
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "phone": "+"}
_IP = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
_WORD = r"[\p{L}\p{M}]+"
SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total, i):
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        fits = F.length(digits).between(12, 19)
        return F.when(fits, _luhn(F.when(fits, digits).otherwise("0"))).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _positions(text: Column, pattern: str, span) -> Column:
    """Matches of a pattern with their places: the text between matches and the matches, walked together.

    ``span(start, end, value)`` gives an array of what a match adds.
    """
    steps = F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(seen, x):
        start = seen["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        return F.struct(
            end.alias("at"),
            F.when(x["hit"].isNull(), seen["out"]).otherwise(F.concat(seen["out"], span(start, end, x["hit"]))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.aggregate(steps, start, step, lambda seen: seen["out"])


def _span(kind: str, rank: int, start: Column, end: Column, value: Column) -> Column:
    return F.array(
        F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), value.alias("value")).cast(SPAN)
    )


def _kind_spans(text: Column, kind: str, rank: int) -> Column:
    hits = _positions(text, PATTERNS[kind], lambda start, end, value: _span(kind, rank, start, end, value))
    return F.filter(hits, lambda s: _valid(kind, s["value"]))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(text: Column) -> Column:
    """All valid base spans of a text, by start, then kind as listed."""
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for rank, kind in enumerate(KINDS):
        likely = text.contains(_NEEDS[kind]) if kind in _NEEDS else text.rlike(r"[0-9][\x20.-]?[0-9]")
        found.append(F.when(likely, _kind_spans(text, kind, rank)).otherwise(none))
    return F.sort_array(F.concat(*found))


def spans_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).otherwise(
        F.when(span["kind"] == "ip", span["value"]).otherwise(F.regexp_replace(span["value"], "[^0-9]", ""))
    )
    return F.concat_ws(":", span["kind"], value)


def entities_of(texts: DataFrame) -> DataFrame:
    """(th, entity, context, n_entity, n_contexts) of the entities with more than one context; a row per text."""
    before = F.col("s.start") - WINDOW
    left = F.expr(f"substring(text, greatest(s.start - {WINDOW}, 0) + 1, least(s.start, {WINDOW}))")
    right = F.expr(f"substring(text, s.end + 1, {WINDOW})")
    # words that the window cuts are left out
    left = F.when(before > 0, F.regexp_replace(left, r"^\S*", "")).otherwise(left)
    right = F.when(F.col("s.end") + WINDOW < F.length("text"), F.regexp_replace(right, r"\S*+$", "")).otherwise(right)
    context = F.xxhash64(F.lower(F.concat_ws(" ", left, right)))
    held = (
        texts.select("th", "text", F.explode("base").alias("s"))
        .select("th", _entity(F.col("s")).alias("entity"), F.col("s.start").alias("start"), context.alias("context"))
        .groupBy("th", "entity")
        .agg(F.min_by("context", "start").alias("context"))
    )
    held = written(held, "held")
    counts = held.groupBy("entity").agg(F.count("*").alias("n_entity"), F.count_distinct("context").alias("n_contexts"))
    return held.join(counts.filter("n_contexts > 1"), "entity")


def terms_of_entities(texts: DataFrame, held: DataFrame) -> DataFrame:
    """``held`` with the different words of the texts outside their base spans: a row per term."""
    outside = F.lower(_clean_text(F.col("text"), F.col("base"), F.lit(" ")))
    words = F.array_distinct(F.regexp_extract_all(outside, F.lit(_WORD), F.lit(0)))
    return held.join(texts, "th").select(*held.columns, F.explode(words).alias("term"))


def disclosing_terms(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms that reach the lower threshold beyond chance."""
    joint = pairs.groupBy("entity", "term", "n_entity", "n_contexts").agg(
        F.count("*").alias("n_both"), F.count_distinct("context").alias("n_together")
    )
    joint = written(joint, "joint")
    tests = joint.count()
    # each different text counts once for each of its words; summed per task before the shuffle
    text = F.coalesce("text", F.lit(""))
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{M}]+"))
    different = documents.select(F.xxhash64(text).alias("th"), words.alias("words")).dropDuplicates(["th"])
    n_term = different.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    total = documents.select(F.xxhash64(text)).distinct().count()
    share, expected = F.col("n_together") / F.col("n_contexts"), F.col("n_term") / F.lit(total)
    surprise = (
        F.when(share <= expected, F.lit(0.0))
        .when(share == 1, -F.log(expected))
        .otherwise(share * F.log(share / expected) + (1 - share) * F.log((1 - share) / (1 - expected)))
    )
    disclosure = F.when(
        F.col("n_entity") < total,
        F.log(total * F.col("n_both") / (F.col("n_term") * F.col("n_entity"))) / F.log(total / F.col("n_entity")),
    )
    return (
        joint.filter("n_together > 1")
        .join(n_term, "term")
        .withColumn("disclosure", disclosure)
        .filter((F.col("disclosure") >= GENERALISE) & (F.col("n_contexts") * surprise >= math.log(max(tests, 1) / CHANCE)))
        .select("entity", "term", "disclosure")
    )


def _with_all_spans(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with base spans, and the spans of the terms that disclose their entities added."""
    found = found.withColumn("th", F.xxhash64("text"))
    texts = found.select("th", "text", "base").dropDuplicates(["th"])
    pairs = terms_of_entities(texts, entities_of(texts))
    per_text = (
        pairs.select("th", "entity", "term")
        .join(disclosing_terms(documents, pairs), ["entity", "term"])
        .groupBy("th", "term")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy("th")
        .agg(
            F.collect_set(F.when(F.col("disclosure") >= REMOVE, F.col("term"))).alias("removed"),
            F.collect_set(F.when(F.col("disclosure") < REMOVE, F.col("term"))).alias("generalised"),
        )
    )
    # texts that share an id share their terms
    per_document = (
        found.filter("doc_id is not null")
        .select("doc_id", "th")
        .distinct()
        .join(per_text, "th")
        .groupBy("doc_id")
        .agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("removed", "generalised")))
    )
    none = F.array().cast(f"array<{SPAN}>")

    def term_span(start, end, value):
        word = F.lower(value)
        return (
            F.when(F.array_contains("removed", word), _span("remove", 4, start, end, value))
            .when(F.array_contains("generalised", word), _span("generalise", 5, start, end, value))
            .otherwise(none)
        )

    has_terms = F.col("removed").isNotNull()
    words = F.when(has_terms, _positions(F.when(has_terms, F.col("text")).otherwise(""), _WORD, term_span)).otherwise(none)
    joined = found.join(per_document, "doc_id", "left")
    return joined.withColumn("spans", F.sort_array(F.concat("base", words))).drop("removed", "generalised", "th")


def personal_data(documents: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans of each document."""
    text = F.coalesce("text", F.lit(""))
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # only texts with base spans are kept; they are a small part and the only ones that can get terms
    found = source.withColumn("base", base_spans(F.col("text"))).withColumn(
        "text", F.when(F.size("base") > 0, F.col("text")).otherwise("")
    )
    found = written(found, "pii")
    plain = found.filter(F.size("base") == 0).withColumn("spans", F.col("base"))
    revealing = _with_all_spans(source, found.filter(F.size("base") > 0))
    columns = ["doc_id", "base", "spans"]
    return (
        plain.select(*columns)
        .unionByName(revealing.select(*columns))
        .select(
            "doc_id",
            *(_count("base", kind).alias(f"n_{kind}") for kind in KINDS),
            F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
            spans_text(F.col("spans")).alias("spans"),
            (F.size("spans") - F.size("base")).cast("long").alias("n_terms"),
        )
    )


def _clean_text(text: Column, spans: Column, by: Column | None = None) -> Column:
    """The text with its spans replaced: [KIND] for base kinds and generalised terms, nothing for removed ones; or ``by``."""

    def step(seen, s):
        ahead = s["start"] >= seen["at"]
        mark = by if by is not None else F.when(s["kind"] == "remove", F.lit("")).when(s["kind"] == "generalise", F.lit("[TERM]")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )
        gap = F.substring(text, seen["at"] + 1, F.greatest(s["start"] - seen["at"], F.lit(0)))
        return F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(ahead, F.concat(seen["out"], gap, mark)).otherwise(seen["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, start, step, lambda seen: F.concat(seen["out"], F.substring(text, seen["at"] + 1, F.length(text)))
    )


def sanitised(documents: DataFrame) -> DataFrame:
    """The documents with their columns; personal data and disclosing terms replaced in ``text``.

    Documents without base spans pass in one narrow step; only the others are written and joined.
    """
    columns = documents.columns
    # the row travels as one value, so that its columns may have any names
    packed = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    marked = packed.withColumn("base", base_spans(F.col("text")))
    plain = marked.filter(F.size("base") == 0).select("row.*")
    found = written(marked.filter(F.size("base") > 0), "pii")
    revealing = _with_all_spans(packed.select("doc_id", "text"), found)
    revealing = revealing.withColumn("clean", _clean_text(F.col("text"), F.col("spans")))
    new = {"text": F.col("clean"), "n_chars": F.length("clean")}
    return plain.unionByName(
        revealing.select(
            *(new[c].cast(documents.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`") for c in columns)
        )
    )


def query(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))
