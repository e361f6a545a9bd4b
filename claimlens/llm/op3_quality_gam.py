"""Quality classifier: a generalised additive model with pairwise interactions.

Text statistics are cut into bins at quantiles of the training rows. Shallow trees are boosted one feature at
a time, over and over (cyclic gradient boosting of the logistic loss); the trees of a feature add up to one
lookup table over its bins. The feature pairs whose joint bins explain most of what is left get a
two-dimensional table each, boosted in the same way with trees of one cut per feature. A score is the
logistic function of the intercept plus the table entries of a document's bins.

The fit uses at most ``TRAIN_ROWS`` labelled documents (those of least hash of doc_id; all of them if
there are fewer); every document is scored. Labels, lang, source and doc_id are no inputs of a score.

Defined results: a null or empty text is scored by the features of an empty text. Labels with a null doc_id or
quality teach nothing; if a doc_id is labelled more than once, it counts as good if any label says so. Without
any label nothing is known against a document, and every score is 1. Repeated rows get equal scores; a null
doc_id is not held out; other columns of the input are ignored.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table, texts

TRAIN_ROWS = 20_000
THRESHOLD = 0.7
ROUNDS, PAIR_ROUNDS, RATE, MAX_BINS, PAIR_BINS, PAIRS = 120, 40, 0.15, 32, 8, 4

FEATURES = (
    "log_chars", "word_chars", "distinct_words", "repeated_neighbours", "upper", "digits", "symbols", "bars",
    "bangs", "stops", "short_words", "line_words", "repeated_lines", "top_word",
)

_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_SYMBOL = np.frombuffer(b"#$%&*+<=>@[]^_`{}~\\/", np.uint8)
_BLANK = np.frombuffer(b" \n\t\r", np.uint8)


def features(text: str) -> tuple[float, ...]:
    """Statistics of one whole text, most of them shares of its words or letters."""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(raw, minlength=256)
    inked = max(1, int(len(raw) - count[_BLANK].sum()))
    lines = [x for x in text.split("\n") if x]
    times = Counter(words)
    repeated = sum(map(operator.eq, words, words[1:]))
    short = sum(map((4).__gt__, map(len, words)))
    return (
        float(np.log1p(len(text))),
        inked / max(1, n),
        len(times) / max(1, n),
        repeated / max(1, n),
        float(count[_UPPER].sum()) / inked,
        float(count[_DIGIT].sum()) / inked,
        float(count[_SYMBOL].sum()) / inked,
        float(count[124]) / max(1, n),
        float(count[33]) / max(1, n),
        float(count[46]) / max(1, n),
        short / max(1, n),
        n / max(1, len(lines)),
        1.0 - len(set(lines)) / max(1, len(lines)),
        max(times.values(), default=0) / max(1, n),
    )


def feature_matrix(batch_texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in batch_texts], np.float64).reshape(-1, len(FEATURES))


# ---------------------------------------------------------------- model


@dataclass
class Gam:
    """Cuts and lookup tables; ``pairs`` holds (i, j, cuts i, cuts j, table)."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += values[np.searchsorted(cuts, x[:, k], side="left")]
        for i, j, ci, cj, values in self.pairs:
            out += values[np.searchsorted(ci, x[:, i], side="left"), np.searchsorted(cj, x[:, j], side="left")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values per bin of a tree of at most ``depth`` levels over ordered bins (gradient and weight sums)."""
    total = _gain(g.sum(), h.sum())
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl)
        best = int(np.argmax(gains))
        if gains[best] > total + 1e-9:
            cut = best + 1
            return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + 1.0))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per cell of the best tree with one cut along each axis."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, choice = -1.0, None
    for a in range(g.shape[0] - 1):
        for b in range(g.shape[1] - 1):
            quads = [
                (c[a, b], c[a, -1] - c[a, b], c[-1, b] - c[a, b], c[-1, -1] - c[a, -1] - c[-1, b] + c[a, b])
                for c in (cg, ch)
            ]
            gain = sum(_gain(x, y) for x, y in zip(*quads, strict=True))
            if gain > best:
                best, choice = gain, (a, b, [x / (y + 1.0) for x, y in zip(*quads, strict=True)])
    out = np.zeros_like(g)
    if choice:
        a, b, v = choice
        out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = v
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of the logistic loss, features first and pairs on what they leave."""
    if not len(y):
        return Gam(np.inf)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Gam(float(np.log(mean / (1 - mean))))
    if y.min() == y.max():
        return model
    model.cuts = [_quantile_cuts(x[:, k], MAX_BINS) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(model.cuts)]
    margin = np.full(len(y), model.intercept)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-margin))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for k, own in enumerate(bins):
            g, h = slopes()
            n = len(model.tables[k])
            step = RATE * _tree(np.bincount(own, g, n), np.bincount(own, h, n), 2)
            model.tables[k] += step
            margin += step[own]
    g, h = slopes()
    coarse = [_quantile_cuts(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    cells = [np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(coarse)]
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            own = cells[i] * shape[1] + cells[j]
            size = shape[0] * shape[1]
            ranked.append((float(_gain(np.bincount(own, g, size), np.bincount(own, h, size)).sum()), i, j))
    for _, i, j in sorted(ranked, reverse=True)[:PAIRS]:
        model.pairs.append((i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))))
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, values in model.pairs:
            g, h = slopes()
            own = cells[i] * values.shape[1] + cells[j]
            sums = [np.bincount(own, v, values.size).reshape(values.shape) for v in (g, h)]
            step = RATE * _pair_tree(*sums)
            values += step
            margin += step[cells[i], cells[j]]
    return model


# ---------------------------------------------------------------- Spark


def held_out():
    """Whether a document's labels are kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Gam:
    """Fits on a sample of at most ``rows`` labelled documents that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id is not null and quality is not null")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    # the rows of least hash: as many at every size, so it is safe to broadcast them and to collect their features
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    columns = ", ".join(f"{c} double" for c in FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix([t.as_py() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), *(pa.array(x[:, k]) for k in range(len(FEATURES)))],
                names=["doc_id", "quality", *FEATURES],
            )

    # of several texts of one id the one of least hash, so that reruns agree
    found = texts(documents).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality")
    found = found.agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = found.mapInArrow(measure, f"doc_id long, quality int, {columns}").toPandas()
    sample = sample.sort_values("doc_id")
    return fit(sample[list(FEATURES)].to_numpy(), (sample["quality"].to_numpy() > 0).astype(float))


SCORED = "doc_id long, score double"


def scored(documents: DataFrame, model: Gam) -> DataFrame:
    """doc_id and score of each document; one pass without a shuffle."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix([t.as_py() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return texts(documents).mapInArrow(score, SCORED)


def kept(documents: DataFrame, model: Gam, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold; no shuffle."""
    columns = documents.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(columns.index("text"))
            x = feature_matrix([t.as_py() or "" for t in text])
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return documents.mapInArrow(keep, documents.schema)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and decision of each document by a model trained here."""
    return scored(documents, train(documents, labels)).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def query(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
