"""Hard-negative mining by angular triangle filtering.

Every row stores its norm and its angle to the nearest of a few reference directions; blocks of rows of one label
and reference are sorted by that angle and keep their range of angles to every reference. For an anchor at angle p and
a row at angle q to the same reference, the angle between them lies in [|p - q|, p + q]. The cosines of both ends, times
the norms, bound the score. So the scores an anchor asks for become a window of angles in each block, widened by a
rounding margin; blocks without a window are skipped, and only rows within windows get integer scores.

The first round finds each anchor's positives (its best rows of the same label), where the window closes as better rows
are found. The second round finds, for each positive, the best rows of other labels whose score lies between a share of
the positive's score and that score. A task is one cell of a grid of anchors times rows; cells have a fixed size, and a
label that holds many rows gets many cells. Anchors are a stated share of the rows, so the work grows with both.

References come from a sample of at most ``SAMPLE`` rows (least hashes of the id); they change the time, not the result.

Defined results: rows with a null id or label, a null vector, or a null or non-finite component take no part, nor do
rows whose integer norm reaches 2**28, as a hundred times their score might not fit a long. Vectors of different length
are not compared. Repeated rows are rows of their own; only the anchor's own row is left out. Equal scores go to the
smaller id. A negative score of a positive leaves no room for negatives. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import table, written

SCALE, EVERY, POSITIVES, NEGATIVES, LEAST_SHARE = 256, 100, 5, 5, (4, 5)
REFERENCES, SAMPLE = 16, 4096
BLOCK_ROWS, WAITING_ROWS, CELL_ROWS, CELL_ANCHORS, ANCHORS_AT_ONCE = 1024, 65_536, 16_384, 4096, 64
LARGEST_NORM = 2.0**28
MARGIN = 1e-5  # radians; rounding of an arc cosine near 1 is about 1e-7
NONE = -(1 << 62)  # the score of a row that was not scored

BLOCKS = (
    "dim int, label long, block long, ref int, n int, least double, most double, near binary, far binary, "
    "ids binary, angles binary, exact binary"
)
ANCHORS = "dim int, label long, block long, pos int, id long, exact binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def known_vectors(vectors: DataFrame, id_col: str, label, vector_col: str) -> DataFrame:
    """id, label and vector of the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST_NORM))
    return rows.filter("id is not null and label is not null and v is not null").filter((F.size("v") > 0) & ~bad)


def _angles(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles (rows x references); a zero vector, whose scores are all 0, counts as orthogonal."""
    cosines = (vectors @ references.T) / np.maximum(norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def references(known: DataFrame) -> dict[int, np.ndarray]:
    """Per length of vector: unit directions, each the sampled one farthest from those before it."""
    sample = known.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    out = {}
    for dim in {len(r.v) for r in sample}:
        x = np.array([r.v for r in sample if len(r.v) == dim])
        norms = np.linalg.norm(x, axis=1)
        x = x[norms > 0] / norms[norms > 0][:, None]
        if not len(x):
            continue
        chosen, closest = [0], x @ x[0]
        while len(chosen) < min(REFERENCES, len(x)):
            chosen.append(int(np.argmin(closest)))
            closest = np.maximum(closest, x @ x[chosen[-1]])
        out[dim] = x[chosen]
    return out


def _directions(given: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return given[dim] if dim in given else np.full((1, dim), dim**-0.5)


def angle_files(known: DataFrame, given: dict[int, np.ndarray], scale: int) -> DataFrame:
    """Blocks of rows of one length, label and nearest reference, sorted by their angle to it."""

    def block(number, dim, label, ref, ids, vectors):
        norms = np.linalg.norm(vectors, axis=1)
        every = _angles(vectors, norms, _directions(given, dim))
        order = np.argsort(every[:, ref], kind="stable")
        return (
            dim, label, number, ref, len(ids), norms.min(), norms.max(), every.min(axis=0).tobytes(), every.max(axis=0).tobytes(),
            ids[order].tobytes(), every[order, ref].tobytes(), vectors[order].astype(np.int32).tobytes(),
        )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made, held = TaskContext.get().partitionId(), 0, 0
        waiting: dict[tuple, list] = {}

        def emptied(keys):
            nonlocal made, held
            out = []
            for key in keys:
                rows = waiting.pop(key)
                held -= len(rows)
                ids, vectors = np.array([i for i, _ in rows], np.int64), np.array([x for _, x in rows])
                for at in range(0, len(rows), BLOCK_ROWS):
                    made += 1
                    out.append(block(part << 32 | made, *key, ids[at : at + BLOCK_ROWS], vectors[at : at + BLOCK_ROWS]))
            return pd.DataFrame(out, columns=_names(BLOCKS))

        for batch in batches:
            lengths = batch["v"].map(len).to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                x = np.floor(np.stack(batch["v"].to_numpy()[at]).astype(np.float64) * scale)
                norms = np.linalg.norm(x, axis=1)
                ref = _angles(x, norms, _directions(given, int(dim))).argmin(axis=1)
                for row, key, label, r, fits in zip(
                    x, batch["id"].to_numpy()[at], batch["label"].to_numpy()[at], ref, norms < LARGEST_NORM, strict=True
                ):
                    if fits:
                        waiting.setdefault((int(dim), int(label), int(r)), []).append((int(key), row))
                        held += 1
            full = [k for k, rows in waiting.items() if len(rows) >= BLOCK_ROWS] if held < WAITING_ROWS else list(waiting)
            if full:
                yield emptied(full)
        if waiting:
            yield emptied(list(waiting))

    return known.mapInPandas(pack, BLOCKS)


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, known by their block and place in it."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                ids = np.frombuffer(row.ids, np.int64)
                exact = np.frombuffer(row.exact, np.int32).reshape(row.n, row.dim)
                chosen = np.flatnonzero(ids % every == 0)
                out += [(row.dim, row.label, row.block, int(p), int(ids[p]), exact[p].tobytes()) for p in chosen]
            yield pd.DataFrame(out, columns=_names(ANCHORS))

    return blocks.select("dim", "label", "block", "n", "ids", "exact").mapInPandas(pick, ANCHORS)


def _cells(anchors: DataFrame, blocks: DataFrame, keys: list[str]):
    """Anchors and blocks of equal ``keys`` in a grid of cells of bounded size."""
    across = blocks.groupBy(*keys).agg(F.ceil(F.sum("n") / CELL_ROWS).alias("across"))
    sizes = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / CELL_ANCHORS).alias("down")).join(across, keys)
    left = anchors.join(sizes, keys).withColumn("g", F.pmod(F.xxhash64("block", "pos"), "down"))
    left = left.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)))
    right = blocks.join(sizes, keys).withColumn("s", F.pmod(F.xxhash64("block"), "across"))
    right = right.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)))
    cell = [*keys, "g", "s"]
    return left.drop("across", "down").groupBy(*cell).cogroup(right.drop("across", "down").groupBy(*cell))


class Rows:
    """The blocks of a cell."""

    def __init__(self, frame: pd.DataFrame, dim: int):
        self.blocks = list(frame.itertuples())
        self.at = np.concatenate([[0], np.cumsum([b.n for b in self.blocks])]).astype(int)
        self.ids = np.concatenate([np.frombuffer(b.ids, np.int64) for b in self.blocks])
        self.exact = [np.frombuffer(b.exact, np.int32).reshape(b.n, dim) for b in self.blocks]
        self.angles = [np.frombuffer(b.angles, np.float64) for b in self.blocks]
        self.near = np.array([np.frombuffer(b.near, np.float64) for b in self.blocks])
        self.far = np.array([np.frombuffer(b.far, np.float64) for b in self.blocks])


class Some:
    """A few anchors of a cell, their scores against the cell's rows, and windows of angles."""

    def __init__(self, frame: pd.DataFrame, dim: int, given: dict[int, np.ndarray], rows: Rows):
        self.rows = rows
        self.keys = list(zip(frame["block"], frame["pos"], frame["id"], strict=True))
        self.labels = frame["label"].to_numpy()
        self.exact = np.array([np.frombuffer(b, np.int32) for b in frame["exact"]]).reshape(len(frame), dim).astype(np.float64)
        self.norms = np.linalg.norm(self.exact, axis=1)
        self.angles = _angles(self.exact, self.norms, _directions(given, dim))
        self.scores = np.full((len(frame), rows.at[-1]), NONE, np.int64)
        # the least angle to any row of each block, by the block's ranges
        gap = np.maximum(rows.near[None] - self.angles[:, None], self.angles[:, None] - rows.far[None])
        self.least = np.maximum(gap.max(axis=2), 0.0) - MARGIN

    def windows(self, b: int, floor: np.ndarray, ceiling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor the places [first, last) of block ``b`` whose score bounds meet [floor, ceiling]."""
        block = self.rows.blocks[b]
        p = self.angles[:, block.ref]
        floor, ceiling = floor.astype(np.float64), ceiling.astype(np.float64)
        # a score of at least floor needs an angle of at most reach
        size = self.norms * np.where(floor > 0, block.most, block.least)
        reach = np.arccos(np.clip(np.divide(floor, size, out=np.full(len(p), -1.0), where=size > 0), -1.0, 1.0)) + MARGIN
        never = (self.least[:, b] > reach) | (floor > self.norms * block.most * (1 + 1e-9) + 1e-3)
        # a score of at most ceiling needs a sum of angles of at least apart
        size = self.norms * block.least
        apart = np.arccos(np.clip(np.divide(ceiling, size, out=np.ones(len(p)), where=size > 0), -1.0, 1.0)) - MARGIN
        first = np.searchsorted(self.rows.angles[b], np.maximum(p - reach, apart - p), "left")
        last = np.searchsorted(self.rows.angles[b], np.minimum(p + reach, 2 * np.pi - apart - p), "right")
        return first, np.where(never, first, np.maximum(first, last))

    def score(self, b: int, who: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> tuple[int, int]:
        """Integer scores of the rows of block ``b`` within the windows of the anchors ``who``; the places scored."""
        first, last = self.windows(b, floor, ceiling)
        who = who[last[who] > first[who]]
        if not len(who):
            return 0, 0
        lo, hi = int(first[who].min()), int(last[who].max())
        block, x = self.rows.blocks[b], self.rows.exact[b][lo:hi]
        a = self.exact[who]
        if self.norms[who].max() * block.most < 2.0**52:  # sums are exact in floating point
            found = np.rint(a @ x.astype(np.float64).T).astype(np.int64)
        else:
            found = a.astype(np.int64) @ x.astype(np.int64).T
        start = int(self.rows.at[b])
        self.scores[who, start + lo : start + hi] = found
        for i in who:
            own, pos, _ = self.keys[i]
            if own == block.block:
                self.scores[i, start + pos] = NONE
        return start + lo, start + hi

    def best(self, i: int, low: int, high: int, k: int) -> np.ndarray:
        """Places of the k best scores in [low, high], ties to the smaller id."""
        s = self.scores[i]
        at = np.flatnonzero((s >= low) & (s <= high) & (s != NONE))
        return at[np.lexsort((self.rows.ids[at], -s[at]))[:k]]


def _chunks(left: pd.DataFrame, right: pd.DataFrame, dim: int, given) -> Iterator[Some]:
    if len(left) and len(right):
        rows = Rows(right, dim)
        for at in range(0, len(left), ANCHORS_AT_ONCE):
            yield Some(left.iloc[at : at + ANCHORS_AT_ONCE], dim, given, rows)


def positives(anchors: DataFrame, blocks: DataFrame, given, k: int) -> DataFrame:
    """Each anchor with its best other rows of the same label, as an array of (rank, id, score)."""

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for some in _chunks(left, right, int(key[0]), given):
            n = len(some.keys)
            everyone, high = np.arange(n), np.full(n, 1 << 62)
            best = np.full((n, k), NONE)
            for b in np.argsort(some.least.mean(axis=0), kind="stable"):
                lo, hi = some.score(int(b), everyone, best.min(axis=1), high)
                both = np.concatenate([best, some.scores[:, lo:hi]], axis=1)
                best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            for i, (block, pos, _) in enumerate(some.keys):
                chosen = some.best(i, int(best[i].min()), 1 << 62, k)
                out += [(block, pos, int(some.rows.ids[c]), int(some.scores[i, c])) for c in chosen]
        return pd.DataFrame(out, columns=["block", "pos", "positive_id", "score"])

    found = _cells(anchors, blocks, ["dim", "label"]).applyInPandas(
        search, "block long, pos int, positive_id long, score long"
    )
    order = Window.partitionBy("block", "pos").orderBy(F.desc("score"), "positive_id")
    ranked = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    lists = ranked.groupBy("block", "pos").agg(
        F.array_sort(F.collect_list(F.struct("nth", "positive_id", "score"))).alias("positives")
    )  # k entries
    return anchors.join(lists, ["block", "pos"])


RESULT = "block long, pos int, nth int, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def negatives(anchors: DataFrame, blocks: DataFrame, given, k: int, share: tuple[int, int]) -> DataFrame:
    """The first k rows of other labels for each anchor and positive; anchors carry their positives."""
    some_of, of_all = share

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, seen = [], 0
        for some in _chunks(left, right, int(key[0]), given):
            own = list(left["positives"].iloc[seen : seen + len(some.keys)])
            seen += len(own)
            wanted = [[(p["nth"], p["positive_id"], p["score"]) for p in ps if p["score"] >= 0] for ps in own]
            asking = np.array([bool(ps) for ps in wanted])
            high = np.array([max((s for _, _, s in ps), default=0) for ps in wanted], np.int64)
            low = np.array([-(-some_of * min((s for _, _, s in ps), default=0) // of_all) for ps in wanted], np.int64)
            for b, block in enumerate(some.rows.blocks):
                some.score(b, np.flatnonzero(asking & (some.labels != block.label)), low, high)
            for i, (block, pos, anchor) in enumerate(some.keys):
                for nth, positive, score in wanted[i]:
                    for c in some.best(i, -(-some_of * score // of_all), score, k):
                        out.append((block, pos, nth, anchor, positive, int(some.rows.ids[c]), score, int(some.scores[i, c])))
        return pd.DataFrame(out, columns=_names(RESULT))

    found = _cells(anchors, blocks, ["dim"]).applyInPandas(search, RESULT)
    order = Window.partitionBy("block", "pos", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    *,
    label=None,
    every: int = EVERY,
    scale: int = SCALE,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    share: tuple[int, int] = LEAST_SHARE,
) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``.

    ``label`` is an expression for the label where the column alone does not give it; ``share`` is the least share
    (numerator, denominator) of the positive's score that a negative must reach.
    """
    known = known_vectors(vectors, id_col, F.col(label_col) if label is None else label, vector_col)
    given = references(known)
    blocks = written(angle_files(known, given, scale), "angle-files")
    anchors = anchors_of(blocks, every)
    with_positives = written(positives(anchors, blocks, given, n_positives), "positives")
    return negatives(with_positives, blocks, given, n_negatives, share).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def query(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


def oracle() -> str:
    return """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and vec_id is not null and label is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, c.vec_id as other_id, a.label = c.label as same,
    cast(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.e) = len(c.e)
  where a.vec_id % 100 = 0
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score
  from (select *, row_number() over (partition by anchor_id order by score desc, other_id) as r from scored where same)
  where r <= 5
), negatives as (
  select p.anchor_id, p.positive_id, s.other_id as negative_id, p.positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as rank
  from positives p join scored s on p.anchor_id = s.anchor_id
  where not s.same and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score
from negatives where rank <= 5"""
