"""Document fingerprints by spot signatures.

A spot is a chain of the next ``CHAIN`` content words after an anchor, a very common word. Other common words are
no content and are skipped. The set of a text's hashed spots is its fingerprint; the likeness of two is the
Jaccard similarity of their sets. ``near_pairs`` finds all pairs of fingerprints over a threshold: sets are
partitioned by length, so that a set meets only lengths that can reach the threshold, and within these only
sets that share one of their rarest spots; the rest is pruned before the exact comparison.

Everything runs on built-in functions.

Defined results: a null text is an empty one. A text without a spot has one signature, the hash of its words, so
equal texts always have equal fingerprints and a likeness of 1. The next document of ``edited_fingerprints`` is
the one with the next smaller doc_id (a null one comes last), equal ids by the hash of the text; after the last
comes the first; a single document follows itself. Repeated rows of one id and text count once in this order
and get equal results. Other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import table, written

CHAIN = 2

# fixed values: common words that open a spot, and further common words that are no content
ANCHORS = (
    "a", "an", "is", "that", "the", "this", "was",
    "das", "der", "die", "ein", "eine", "ist",
    "dans", "est", "la", "le", "les", "un", "une",
    "el", "en", "es", "las", "los", "una",
)
COMMON = (
    "and", "are", "as", "at", "be", "by", "for", "from", "in", "it", "not", "of", "on", "or", "to", "with",
    "auf", "dem", "den", "des", "für", "im", "mit", "nicht", "sich", "und", "von", "zu",
    "au", "avec", "de", "du", "et", "par", "pas", "pour", "que", "qui", "sur",
    "con", "del", "no", "para", "por", "se", "su", "y",
)


def _any_of(words) -> str:
    """Alternatives by first letter, so that most words are ruled out by one look."""
    parts = []
    for first, group in groupby(sorted(set(words)), key=lambda w: w[0]):
        rest = sorted((w[1:] for w in group), key=len, reverse=True)
        parts.append(first + "(?:" + "|".join(rest) + ")")
    return "(?:(?:" + "|".join(parts) + ") )++"


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Distinct hashed spots of a text, as array<int>."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    content = F.regexp_replace(words, "(?<= )" + _any_of(COMMON), "")
    marked = F.regexp_replace(content, "(?<= )" + _any_of(ANCHORS), "§ ")
    link = "(?:§ )?+[^ §]++"
    spots = F.regexp_extract_all(marked, F.lit(f"§ (?=([^ §]++(?: {link}){{{chain - 1}}}) )"), F.lit(1))
    hashed = F.array_distinct(F.transform(spots, lambda s: F.hash(F.replace(s, F.lit("§ "), F.lit("")))))
    return F.when(F.size(hashed) > 0, hashed).otherwise(F.array(F.hash(words)))


def fingerprint(signature: Column) -> Column:
    return F.concat_ws(" ", F.sort_array(signature).cast("array<string>"))


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and signature set of each document with an id."""
    text = F.coalesce("text", F.lit(""))
    return documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), signatures(text).alias("sig"))


def near_pairs(prints: DataFrame, threshold: float) -> DataFrame:
    """a, b, likeness of the different fingerprints over the threshold; each stands for its least doc_id.

    A set of n spots meets lengths from n up to n / threshold, which lie in its own length partition or the
    next. Two sets over the threshold share one of their first n - ceil(threshold * n) + 1 spots in any common
    order; the order is by frequency, so they meet at rare spots only.
    """
    same = prints.groupBy(F.sort_array("sig").alias("sig")).agg(F.min("doc_id").alias("id"))
    sets = written(same.withColumn("n", F.size("sig")), "spots")
    spots = sets.select("id", "n", F.explode("sig").alias("spot"))
    ranked = spots.join(spots.groupBy("spot").agg(F.count("*").alias("times")), "spot")
    rarest = F.sort_array(F.collect_list(F.struct("times", "spot")))
    prefix = F.slice("spots", F.lit(1), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)
    ranked = ranked.groupBy("id", "n").agg(rarest.alias("spots")).select("id", "n", F.explode(prefix).alias("s"))
    ranked = ranked.select("id", "n", F.col("s.spot").alias("spot"))
    ranked = ranked.withColumn("lengths", F.floor(F.log("n") / -F.log(F.lit(threshold)) + 1e-9))
    longer = ranked.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "spot", "lengths")
    shorter = ranked.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "spot", "lengths")
    shorter = shorter.withColumn("lengths", F.explode(F.array("lengths", F.col("lengths") + 1)))
    fits = (F.col("n_a") >= F.col("n_b") * threshold - 1e-9) & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))))
    met = shorter.join(longer, ["lengths", "spot"]).filter(fits).select("a", "b").distinct()
    known = sets.select("id", "sig")
    pairs = met.join(known.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        known.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b"
    )
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness(F.col("sig_a"), F.col("sig_b")).alias("likeness"))
    return pairs.filter(F.col("likeness") >= threshold)


def following(rows: DataFrame, keys: list[str]) -> DataFrame:
    """For each distinct key in descending order the key of the next row, cyclic: ``keys`` and ``next_<key>``.

    The rows are sorted over the cluster and numbered within their partitions; only the ends of partitions, as many
    rows as there are partitions, are ordered in one task.
    """
    order = [F.col(keys[0]).desc_nulls_last(), *(F.col(k).desc() for k in keys[1:])]
    numbered = written(rows.select(*keys).distinct().orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftright("at", 33)
    ends = numbered.groupBy(part.alias("part")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    by_part = Window.orderBy("part")
    ends = ends.select(
        "part", "last", F.coalesce(F.lead("first").over(by_part), F.first("first").over(by_part)).alias("after_last")
    )
    stepped = numbered.join(F.broadcast(ends), part == ends["part"]).select(
        *keys, F.when(F.col("at") == F.col("last"), F.col("after_last")).otherwise(F.col("at") + 1).alias("at")
    )
    return stepped.join(numbered.select("at", *(F.col(k).alias(f"next_{k}") for k in keys)), "at").drop("at")


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the next one."""
    text = F.coalesce("text", F.lit(""))
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # a null id gets a key of its own, as null keys do not join
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    base = base.withColumns({"key": key, "digest": F.xxhash64("text"), "n": F.length("text")})
    links = following(base, ["key", "digest", "n"]).select(
        F.col("next_key").alias("key"),
        F.col("next_digest").alias("digest"),
        F.col("key").alias("to_key"),
        F.col("digest").alias("to_digest"),
        F.floor(F.col("n") / 3).cast("int").alias("need"),
    )
    own = base.drop("n").withColumn("sig", signatures(F.col("text")))
    # texts are dealt out once, by key; each sends its head and signatures to the document before it
    # (a row number instead of the lag would be filtered before the exchange, which then could not be shared)
    again = F.lag(F.lit(1)).over(Window.partitionBy("key", "digest").orderBy("doc_id"))
    heads = (
        own.withColumn("again", again)
        .filter("again is null")
        .join(links, ["key", "digest"])
        .select(
            F.col("to_key").alias("key"),
            F.col("to_digest").alias("digest"),
            F.expr("left(text, need)").alias("head"),
            F.col("sig").alias("next_sig"),
            F.col("doc_id").alias("next_id"),
        )
    )
    n = F.length("text")
    edited = F.concat(F.expr("left(text, cast(length(text) - floor(length(text) / 3) as int))"), F.col("head"))
    joined = own.join(heads, ["key", "digest"]).select(
        "doc_id", n.cast("long").alias("n_chars"), "sig", "next_sig", "next_id", edited.alias("edited")
    )
    joined = joined.withColumn("edited_sig", signatures(F.col("edited")))
    return joined.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sig")).alias("fingerprint"),
        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
        "next_id",
    )


def query(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))
