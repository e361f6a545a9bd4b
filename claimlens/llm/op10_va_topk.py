"""Exact top-k search by integer inner product with vector-approximation files.

Vectors are packed in blocks. A block keeps, for each dimension, the least value and a cell width, and one
byte per component: the cell it lies in. Scanning the cells alone gives a lower and an upper bound of each inner
product. The first pass keeps per query the k-th best lower bound of a group of blocks; the best of these is
a score that the k-th result surely reaches. The second pass takes the vectors whose upper bound reaches it,
reads their exact values in the order of the bounds, and stops when no bound left reaches the k-th exact
score. Bounds are exact integers in floating point, so no result is lost.

Queries meet blocks in groups: a stated query set against all rows. A task gets one block of queries and a
few blocks of vectors, a cell of a grid with about one cell per task; cells have a greatest size, so nothing in a
task grows without bound. Each side is repeated once per row or column of the grid.

Defined results: vectors that are null, or hold a null or non-finite component, and rows with a null vec_id
take no part. Vectors of different lengths are not compared. Each row whose id is divisible by ``every`` is a
query, repeated rows included; only the query's own row is left out of its candidates, so an equal row is one.
Equal scores go to the smaller vec_id. Scores must fit a long. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import table, written

SCALE = 1024
BLOCK_ROWS, QUERY_ROWS, BLOCKS_PER_GROUP = 1024, 1024, 4
#: a task's share grows with the table up to these bounds, which keep it within a task's memory
MOST_QUERY_ROWS, MOST_BLOCKS = 4096, 64

BLOCKS = "dim int, block long, n int, wide boolean, ids binary, low binary, width binary, cells binary, exact binary"
QUERIES = "dim int, g long, n int, wide boolean, ids binary, block binary, pos binary, exact binary"


def _ints(values: np.ndarray) -> tuple[np.ndarray, bool]:
    wide = bool(values.size) and int(np.abs(values).max()) >= 1 << 31
    return values.astype(np.int64 if wide else np.int32), wide


def _exact(row) -> np.ndarray:
    return np.frombuffer(row.exact, np.int64 if row.wide else np.int32).reshape(row.n, row.dim).astype(np.int64)


def _block(dim: int, block: int, ids: list[int], vectors: np.ndarray) -> tuple:
    exact, wide = _ints(vectors)
    low = vectors.min(axis=0)
    width = (vectors.max(axis=0) - low) // 256 + 1
    cells = ((vectors - low) // width).astype(np.uint8)
    return (
        dim, block, len(ids), wide, np.array(ids, np.int64).tobytes(), low.tobytes(), width.tobytes(),
        cells.tobytes(), exact.tobytes(),
    )


def approximation_file(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` vectors of one length; made inside the input's partitions."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def block(dim):
            nonlocal made
            ids, rows = waiting.pop(dim)
            made += 1
            return _block(dim, part << 32 | made, ids, np.array(rows, np.int64).reshape(len(ids), dim))

        for batch in batches:
            out = []
            for key, vector in zip(batch["id"].array, batch["v"].array, strict=True):
                x = np.floor(np.asarray(vector, np.float64) * SCALE)
                if not np.isfinite(x).all():
                    continue
                ids, rows = waiting.setdefault(len(x), ([], []))
                ids.append(int(key))
                rows.append(x)
                if len(ids) == BLOCK_ROWS:
                    out.append(block(len(x)))
            if out:
                yield pd.DataFrame(out, columns=_names(BLOCKS))
        if waiting:
            yield pd.DataFrame([block(dim) for dim in list(waiting)], columns=_names(BLOCKS))

    known = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    known = known.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull()))
    return known.mapInPandas(pack, BLOCKS)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def query_blocks(blocks: DataFrame, every: int) -> DataFrame:
    """The vectors whose id is divisible by ``every``, in blocks of about ``QUERY_ROWS``."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                ids, exact = np.frombuffer(row.ids, np.int64), _exact(row)
                out += [(row.dim, row.block, int(p), int(ids[p]), exact[p].tobytes()) for p in np.flatnonzero(ids % every == 0)]
            yield pd.DataFrame(out, columns=["dim", "block", "pos", "id", "exact"])

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "pos"])
        dim = int(key[0])
        exact, wide = _ints(np.frombuffer(b"".join(rows["exact"]), np.int64).reshape(len(rows), dim))
        block, pos, ids = (rows[c].to_numpy(np.int64).tobytes() for c in ("block", "pos", "id"))
        return pd.DataFrame([(dim, int(key[1]), len(rows), wide, ids, block, pos, exact.tobytes())], columns=_names(QUERIES))

    found = blocks.select("dim", "block", "n", "wide", "ids", "exact").mapInPandas(
        pick, "dim int, block long, pos int, id long, exact binary"
    )
    found = written(found, "queries")
    rows = found.count()
    side = max(1, round(_tasks(blocks.sparkSession) ** 0.5))
    groups = max(1, -(-rows // min(max(-(-rows // side), QUERY_ROWS), max(MOST_QUERY_ROWS, QUERY_ROWS))))
    return found.withColumn("g", F.pmod(F.xxhash64("block", "pos"), F.lit(groups))).groupBy("dim", "g").applyInPandas(pack, QUERIES)


def _tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _meetings(queries: DataFrame, blocks: DataFrame, columns: list[str]):
    """Both sides by (dim, query block, group of vector blocks).

    The cells form a grid with about as many as the session has shuffle partitions, so its sides, and with them the
    copies of each side's rows, grow with the square root of the number of tasks and not with the table, until a
    cell has reached its greatest size.
    """
    known = blocks.count()
    side = max(1, -(-_tasks(blocks.sparkSession) // max(1, queries.select("g").distinct().count())))
    groups = max(1, -(-known // min(max(-(-known // side), BLOCKS_PER_GROUP), max(MOST_BLOCKS, BLOCKS_PER_GROUP))))
    own = queries.select(F.col("dim").alias("dim"), F.col("g").alias("g"))
    left = queries.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("s", F.col("s").cast("long"))
    right = (
        blocks.select("dim", "block", "n", "wide", "ids", *columns)
        .withColumn("s", F.pmod(F.xxhash64("block"), F.lit(groups)))
        .join(own, "dim")
    )
    keys = ["dim", "g", "s"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


class _Queries:
    def __init__(self, row):
        self.n = row.n
        self.ids, self.block, self.pos = (np.frombuffer(b, np.int64) for b in (row.ids, row.block, row.pos))
        self.exact = _exact(row)

    def bounds(self, row) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all inner products with a block, -inf where a query meets itself."""
        low, width = np.frombuffer(row.low, np.int64), np.frombuffer(row.width, np.int64)
        cells = np.frombuffer(row.cells, np.uint8).reshape(row.n, row.dim)
        q = self.exact.astype(np.float64)
        half = (width - 1) / 2.0
        middle = (q * width) @ cells.astype(np.float64).T + (q @ (low + half))[:, None]
        reach = (np.abs(q) @ half)[:, None]
        slack = (np.abs(middle) + reach + 1) * 1e-12 if np.abs(middle).max(initial=0) > 2**50 else 0.0
        lower, upper = middle - reach - slack, middle + reach + slack
        own = np.flatnonzero(self.block == row.block)
        lower[own, self.pos[own]] = upper[own, self.pos[own]] = -np.inf
        return lower, upper


def _sure(queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Per query block: a score that each query's k-th result surely reaches."""

    def scan(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"dim": [], "g": [], "query": [], "sure": []})
        q = _Queries(next(left.itertuples()))
        best = np.full((q.n, k), -np.inf)
        for row in right.itertuples():
            lower, _ = q.bounds(row)
            both = np.concatenate([best, lower], axis=1)
            best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        return pd.DataFrame({"dim": int(key[0]), "g": int(key[1]), "query": np.arange(q.n), "sure": best.min(axis=1)})

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        sure = rows.sort_values("query")["sure"].to_numpy(np.float64)
        return pd.DataFrame([(int(key[0]), int(key[1]), sure.tobytes())], columns=["dim", "g", "sure"])

    scanned = _meetings(queries, blocks, ["low", "width", "cells"]).applyInPandas(scan, "dim int, g long, query int, sure double")
    sure = scanned.groupBy("dim", "g", "query").agg(F.max("sure").alias("sure"))
    return sure.groupBy("dim", "g").applyInPandas(pack, "dim int, g long, sure binary")


def _visit(q: _Queries, i: int, row, ids, exact, upper, floor, kept: list, k: int) -> list:
    """Exact scores of one block for query ``i`` in the order of the bounds, until the k-th is certain."""
    goal = max(floor, kept[k - 1][0] if len(kept) >= k else -np.inf)
    candidates = np.flatnonzero(upper >= goal)
    candidates = candidates[np.argsort(-upper[candidates], kind="stable")]
    plain = int(np.abs(exact).max(initial=0)) * int(np.abs(q.exact[i]).max(initial=0)) * max(1, row.dim) < 1 << 62
    for at in range(0, len(candidates), 4 * k):
        chunk = candidates[at : at + 4 * k]
        if upper[chunk[0]] == -np.inf or (len(kept) >= k and upper[chunk[0]] < kept[k - 1][0]):
            break
        chunk = chunk[upper[chunk] > -np.inf]
        scores = exact[chunk] @ q.exact[i] if plain else exact[chunk].astype(object) @ q.exact[i].astype(object)
        kept = kept + [(int(s), int(v)) for s, v in zip(scores, ids[chunk], strict=True)]
        kept = sorted(kept, key=lambda x: (-x[0], x[1]))[:k]
    return kept


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The k best candidates of each query row: query_id, rank, vec_id, score."""
    blocks = written(approximation_file(vectors), "cells")
    queries = written(query_blocks(blocks, every), "query-blocks")
    sure = written(_sure(queries, blocks, k), "sure")

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["block", "pos", "query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in names})
        head = next(left.itertuples())
        q, sure = _Queries(head), np.frombuffer(head.sure, np.float64)
        kept: list[list] = [[] for _ in range(q.n)]
        for row in right.itertuples():
            _, upper = q.bounds(row)
            ids, exact = np.frombuffer(row.ids, np.int64), _exact(row)
            for i in range(q.n):
                kept[i] = _visit(q, i, row, ids, exact, upper[i], sure[i], kept[i], k)
        rows = [(int(q.block[i]), int(q.pos[i]), int(q.ids[i]), v, s) for i in range(q.n) for s, v in kept[i]]
        return pd.DataFrame(rows, columns=names)

    found = _meetings(queries.join(sure, ["dim", "g"]), blocks, ["low", "width", "cells", "exact"]).applyInPandas(
        search, "block long, pos long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("block", "pos").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


def oracle() -> str:
    return """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 100 = 0
)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 10"""
