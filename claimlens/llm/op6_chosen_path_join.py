"""Jaccard join of word n-grams by chosen paths.

Equal texts form one text class; only classes are compared. A class has a MinHash sketch: each coordinate is a
sampled token, and two sets share it with the probability of their similarity. A run splits all classes by one
sampled token, splits buckets that are still large by one or two further ones, and so on; what reaches a
bucket by its path is compared with it by brute force. A pair at the threshold meets in a run with a probability
of at least ``MEET``, so runs are repeated until the target recall is reached; the comparison itself uses the sets.

Buckets that stay large after the last split, such as a big group of near copies, are compared in pairs of
blocks. Compared pairs stay inside the task: it gives, per class, the number of links and one member of its
local component. A pair that meets in several buckets is counted in the least of them only, which both sides
know from the list of their buckets. Components of links over all buckets give the class ids.

Words are what white space separates. Texts of one to four words have one n-gram of all their words. Sets hold
32-bit hashes of n-grams.

Defined results: a text without words, null or empty, is linked with equal texts only. Rows with a null doc_id take
part like others and come last; ids that several texts share name each of them. A group of rows without ids has a null
class_id. Repeated rows count as copies of their text. Other columns of the input are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import (
    LAST_ID,
    MAYBE,
    clashing,
    order_id,
    other_hash,
    possibly,
    table,
    text_key,
    texts,
    written,
)

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: least probability that a pair at the threshold meets in a run of three splits (1.25 tokens from the second on)
MEET = 0.58
BUCKET, BLOCK = 256, 256
COLUMNS_AT_ONCE = 8192

SKETCH = "doc_id long, c long, other long, n int, sketch array<int>, grams binary"
LINKS = "c long, root long, n_texts long, n_docs long"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def runs_for(recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - MEET)))


def run_tokens(runs: int) -> list[tuple[int, list[int], list[int]]]:
    """Per run the coordinates of its three splits; every fourth run takes two tokens at a later split."""
    out, free = [], 0
    for r in range(runs):
        second = [free + 1 + i for i in range(2 if r % 4 == 0 else 1)]
        third = [second[-1] + 1 + i for i in range(2 if r % 4 == 1 else 1)]
        out.append((free, second, third))
        free = third[-1] + 1
    return out


class _Powers:
    """Powers of the hash base and of its inverse, grown as texts ask for them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))

    def upto(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            ones = np.full(size, _BASE, np.uint64)
            ones[0] = 1
            self.up = np.multiply.accumulate(ones)
            ones[1:] = self.inverse
            self.down = np.multiply.accumulate(ones)
        return self.up, self.down


_POWERS = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the word n-grams of a text, from running sums of its bytes."""
    raw = np.frombuffer((" ".join(text.split()) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) < 2:
        return np.zeros(0, np.uint64)
    up, down = _POWERS.upto(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(ends) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(ends) - words + 1], ends[words - 1 :]
    return mixed((sums[ends] - sums[starts]) * down[starts])


def sketches(documents: DataFrame, coordinates: int, words: int = WORDS, clashes: list[int] = ()) -> DataFrame:
    """Text class, MinHash sketch and n-gram set of each document; doc_id is its place, nulls last."""
    factor = np.random.RandomState(11).randint(1, 1 << 62, coordinates).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, sets = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                grams = np.unique(gram_hashes(text, words) >> np.uint64(32)).astype(np.uint32)
                least = np.full(coordinates, 0xFFFFFFFF, np.uint64)
                wide = mixed(grams.astype(np.uint64) + np.uint64(1))
                for at in range(0, len(wide), 4096):
                    values = (factor[:, None] * wide[None, at : at + 4096]) >> np.uint64(32)
                    np.minimum(least, values.min(axis=1), out=least)
                sizes.append(len(grams))
                found.append(least.astype(np.uint32).view(np.int32))
                sets.append(grams.tobytes())
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            offsets = np.arange(len(found) + 1, dtype=np.int32) * coordinates
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("doc_id", "c", "other")), pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sets, pa.binary()),
                ],
                names=["doc_id", "c", "other", "n", "sketch", "grams"],
            )

    text = F.col("text")
    rows = texts(documents).select(
        order_id().alias("doc_id"), text_key(text, list(clashes)).alias("c"), other_hash(text).alias("other"), "text"
    )
    return rows.mapInArrow(sketch, SKETCH)


# ---------------------------------------------------------------- paths


def _split(walks: DataFrame):
    """(members of small buckets, members of large ones) with the bucket's size; single members are done."""
    sizes = walks.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
    met = walks.join(sizes, "path")
    return met.filter(F.col("size") <= BUCKET), met.filter(F.col("size") > BUCKET)


def buckets(sketched: DataFrame, runs: int) -> DataFrame:
    """(leaf, lo, hi, block, c): members of the buckets to compare; lo and hi name a pair of blocks."""
    steps = run_tokens(runs)

    def token(i):
        return F.col("sketch")[i]

    starts = F.array(
        *(
            F.struct(
                F.xxhash64(F.lit(r), token(first)).alias("path"),
                *(
                    (token(split[i]) if i < len(split) else F.lit(None).cast("int")).alias(f"{level}{i}")
                    for level, split in (("second", second), ("third", third))
                    for i in range(2)
                ),
            )
            for r, (first, second, third) in enumerate(steps)
        )
    )
    # copies of a text walk once
    walks = sketched.filter("n > 0").select("c", F.explode(starts).alias("w")).select("c", "w.*").distinct()
    walks = written(walks, "walks")
    small, large = _split(walks)
    leaves = [small.select("path", "c")]
    for level in ("second", "third"):
        tokens = F.array(f"{level}0", f"{level}1")
        deeper = large.select("c", "path", "third0", "third1", F.posexplode(tokens).alias("i", "value"))
        deeper = deeper.filter("value is not null")
        deeper = deeper.select("c", F.xxhash64("path", "i", "value").alias("path"), "third0", "third1")
        small, large = _split(written(deeper, "walks"))
        leaves.append(small.select("path", "c"))
    few = leaves[0].unionByName(leaves[1]).unionByName(leaves[2])
    # at most BUCKET members each; the same members are met once, whichever runs brought them together
    few = few.groupBy("path").agg(F.sort_array(F.collect_set("c")).alias("members")).filter(F.size("members") > 1)
    few = few.select(F.xxhash64("members").alias("leaf"), "members").distinct().select("leaf", F.explode("members").alias("c"))
    few = few.select("leaf", *(F.lit(0).alias(x) for x in ("lo", "hi", "block")), "c")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    many = large.select(F.col("path").alias("leaf"), "c", blocks.alias("blocks"))
    many = many.withColumn("block", F.pmod(F.xxhash64("c", "leaf"), F.col("blocks")).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.select("leaf", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "c")
    return few.unionByName(many)


# ---------------------------------------------------------------- comparison


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over the values that two sets have."""
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.float32)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    out = np.zeros((m, m), np.float32)
    if len(column):
        column = np.cumsum(np.concatenate([[0], (np.diff(column) > 0).astype(np.int64)]))
        for at in range(0, int(column[-1]) + 1, COLUMNS_AT_ONCE):
            a, b = np.searchsorted(column, [at, at + COLUMNS_AT_ONCE])
            matrix = np.zeros((m, min(COLUMNS_AT_ONCE, int(column[b - 1]) - at + 1)), np.float32)
            matrix[owner[a:b], column[a:b] - at] = 1
            out += matrix @ matrix.T
    return out


def bucket_links(leaf: int, cross: bool, rows: list[tuple], similarity: float) -> list[tuple]:
    """(class, least class of its component here, linked texts, linked documents) of the linked members.

    ``rows``: (class, block, documents, n-gram set, buckets of the class). Counts leave out pairs that also meet
    in a lesser bucket.
    """
    m = len(rows)
    sets = [r[3] for r in rows]
    size = np.array([len(s) for s in sets], np.float64)
    both = shared_counts(sets).astype(np.float64)
    linked = both * (1 + similarity) >= similarity * (size[:, None] + size[None, :]) - 1e-6
    np.fill_diagonal(linked, False)
    block = np.array([r[1] for r in rows])
    if cross:
        linked &= block[:, None] != block[None, :]
    if not linked.any():
        return []
    earlier = [[x for x in r[4] if x < leaf] for r in rows]
    seen = {x: i for i, x in enumerate(sorted({x for e in earlier for x in e}))}
    counted = linked
    if seen:
        incidence = np.zeros((m, len(seen)), np.float32)
        for i, e in enumerate(earlier):
            incidence[i, [seen[x] for x in e]] = 1
        counted = linked & (incidence @ incidence.T == 0)
    docs = np.array([r[2] for r in rows], np.int64)
    label = np.arange(m)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], m).min(axis=1))
        if (least == label).all():
            break
        label = least
    names = [r[0] for r in rows]
    low: dict[int, int] = {}
    for i in range(m):
        low[label[i]] = min(low.get(label[i], names[i]), names[i])
    return [
        (names[i], low[label[i]], int(counted[i].sum()), int((counted[i] * docs).sum())) for i in np.flatnonzero(linked.any(axis=1))
    ]


def links(sketched: DataFrame, met: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """Links of the classes found in all buckets."""
    known = met.groupBy("c").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    known = known.join(sizes.select("c", "first_id", F.col("size").alias("docs")), "c")
    # sets are dealt out once by class and once by bucket; a repeated row of a first copy is left out there
    sets = sketched.select("c", "doc_id", "grams").join(known, "c").filter("doc_id = first_id")
    sets = sets.select("c", "docs", "leaves", "grams")
    keyed = met.join(sets, "c").repartition("leaf", "lo", "hi").sortWithinPartitions("leaf", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, seen = None, [], set()

        def done():
            return bucket_links(key[0], key[1] != key[2], rows, similarity) if len(rows) > 1 else []

        for batch in batches:
            out = []
            columns = [batch.column(x).to_pylist() for x in ("leaf", "lo", "hi", "block", "c", "docs", "leaves", "grams")]
            for leaf, lo, hi, block, c, docs, leaves, grams in zip(*columns, strict=True):
                if (leaf, lo, hi) != key:
                    out += done()
                    key, rows, seen = (leaf, lo, hi), [], set()
                if (c, block) in seen:
                    continue
                seen.add((c, block))
                rows.append((c, block, docs, np.frombuffer(grams, np.uint32), leaves))
            yield _link_batch(out)
        if rows:
            yield _link_batch(done())

    return keyed.select("leaf", "lo", "hi", "block", "c", "docs", "leaves", "grams").mapInArrow(compare, LINKS)


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["c", "root", "n_texts", "n_docs"])


def components(edges: DataFrame) -> DataFrame:
    """(c, label): the least class of each component. Least labels spread over edges and along labels, so the number
    of rounds grows with the logarithm of a chain's length; each round is written to the shared folder."""
    edges = written(edges.select("c", "root").union(edges.select("root", "c")).distinct(), "edges")
    labels = written(edges.groupBy("c").agg(F.least(F.min("root"), F.col("c")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("c").alias("root"), F.col("label").alias("other")), "root")
        near = near.groupBy("c").agg(F.min("other").alias("other"))
        jump = labels.select(F.col("c").alias("label"), F.col("label").alias("beyond"))
        new = (
            labels.join(near, "c")
            .join(jump, "label")
            .select("c", F.least("label", "other", "beyond").alias("label"), F.col("label").alias("old"))
        )
        new = written(new, "labels")
        if not new.filter("label <> old").limit(1).count():
            return new.select("c", "label")
        labels = new.select("c", "label")


def text_groups(
    documents: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> tuple[DataFrame, DataFrame, list[int]]:
    """(documents: place and text class c; texts: c, their group's ``label``, first place, and numbers of linked
    other documents and texts; the clashes that ``text_key`` needs)."""
    runs = runs_for(recall)
    coordinates, clashes = run_tokens(runs)[-1][2][-1] + 1, []
    while True:
        sketched = written(sketches(documents, coordinates, words, clashes), "sketches")
        sizes = sketched.groupBy("c").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("size"), F.min("other").alias("a"), F.max("other").alias("b")
        )
        sizes = written(sizes, "sizes")
        if clashes or not (clashes := clashing(sizes, "c")):
            break
    met = written(buckets(sketched.select("c", "n", "sketch"), runs), "met")
    found = written(links(sketched, met, sizes, similarity), "links")
    labels = components(found.filter("c <> root"))
    counts = found.groupBy("c").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    named = written(
        sizes.join(counts, "c", "left")
        .join(labels, "c", "left")
        .select(
            "c",
            F.coalesce("label", "c").alias("label"),
            "first_id",
            (F.coalesce("n_docs", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_text_links"),
        ),
        "classes",
    )
    return sketched.select("doc_id", "c"), named, clashes


def near_classes(documents: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Per document: class_id (least doc_id of its group of links), text_id (least doc_id of its text), and numbers
    of linked other documents and other texts."""
    rows, named, _ = text_groups(documents, words, similarity, recall)
    ids = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    named = named.join(ids, "label").withColumnRenamed("first_id", "text_id")
    known = [F.when(F.col(x) < LAST_ID, F.col(x)).alias(x) for x in ("doc_id", "class_id", "text_id")]
    return rows.join(named, "c").select(*known, "n_links", "n_text_links")


def one_of_each(documents: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The first document of each group of near copies, with its columns: that of the least doc_id (of several texts of
    that id the one of the least key; nulls last). A row that repeats the id and text of the one that stays goes."""
    rows, named, clashes = text_groups(documents, words, similarity, recall)
    chosen = named.groupBy("label").agg(F.min(F.struct("first_id", "c")).alias("first"))
    chosen = written(chosen.select(F.col("first.first_id").alias("_first"), F.col("first.c").alias("_c")), "chosen")
    counts = rows.groupBy(F.col("doc_id").alias("_first"), F.col("c").alias("_c")).agg(F.count("*").alias("n"))
    gone = counts.join(chosen, ["_first", "_c"], "left_anti").unionByName(counts.filter("n > 1"))
    marked = documents.withColumns(
        {"_first": order_id(), "_c": text_key(F.coalesce("text", F.lit("")), clashes)}
    )
    # most documents stay and are one of a kind: they need not be dealt out
    told = possibly(marked, written(gone.select("_first", "_c"), "gone"), ["_first", "_c"])
    asked = told.filter(MAYBE).join(chosen, ["_first", "_c"], "left_semi").dropDuplicates(["_first", "_c"])
    return told.filter(~F.col(MAYBE)).select(*documents.columns).unionByName(asked.select(*documents.columns))


def query(spark, sf_dir):
    return near_classes(table(spark, sf_dir, "documents"))
