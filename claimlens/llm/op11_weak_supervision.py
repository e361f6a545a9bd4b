"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters say that a text is toxic (or, two of them, that it is not) or nothing. There are fixed ones, a word list and
patterns, and ones induced from labelled documents: whole words and openings of longer words that stand in toxic
documents far more often than in others, once or at least twice. The label model takes the true class as hidden. It
estimates, by expectation maximisation over labelled and unlabelled documents, how often each voter speaks in either
class and which voters are correlated within a class: the tree of greatest conditional mutual information joins them,
so that voters that say the same thing do not count twice. A known label is one more voter, with a small fixed error.
A logistic regression over term counts and densities is trained on the posterior labels; its probability is the score.

The model is fitted on a bounded sample of documents that are not held out: at most ``TOXIC_ROWS`` and
``CLEAN_ROWS`` labelled ones and ``OTHER_ROWS`` without a label (those of least hash of doc_id), weighted so that
the classes keep their shares. Every document is scored, whole. Labels, lang, source and doc_id are no inputs of a score.

Defined results: a null or empty text is scored by the features of an empty text. Labels with a null doc_id or mark
teach nothing; if a doc_id is labelled more than once, it counts as toxic if any label says so; of several texts of one
doc_id the one of least hash is learnt from. Without any label the fixed voters alone decide the posterior labels;
without any document to learn from every score is 0. Repeated rows get equal scores; a null doc_id is not held out.
Words of more than ``LONGEST`` characters are counted but never terms. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table, texts, written

THRESHOLD = 0.3
TOXIC_ROWS, CLEAN_ROWS, OTHER_ROWS = 6_000, 10_000, 4_000
TERMS, LEAST_G2, VOTERS, DENSE = 1_000, 12.0, 64, 150
OPENINGS, LONGEST, MEMO = range(3, 9), 40, 300_000
LABEL_HIT, LABEL_FALSE = 0.995, 0.002  # chance of the label "toxic" for a toxic and for another document
ROUNDS, EDGE_G2, PENALTY = 15, 20.0, 0.5

# Insults that open the vote, one voter each.
INSULTS = (
    "abschaum clown crétin débile disgusting dumb dummkopf estúpido fool freak idiot idiota idiote imbecile imbécil "
    "imbécile jerk liar loser moron ordure pathetic scum stupid stupide trash trottel ugly useless worthless"
).split()

_WORD = re.compile(r"\w+")
_INSULT = "(?:" + "|".join(INSULTS) + ")"
_DIRECTED = re.compile(rf"\b(?:you|your|du|ihr|tu|vous|eres|sois)\b(?:\W+\w+){{0,3}}?\W+{_INSULT}s?\b")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .*_-]){3,20}\w(?!\w)")
_MASKED = re.compile(r"(?<!\w)[a-z]+[013457@$!*][a-z013457@$!*]*(?!\w)")
_PLAIN = str.maketrans("013457@$!", "oieastasi")
PATTERNS = ("directed", "spaced", "masked", "shouted")


def patterns(text: str, low: str) -> tuple[bool, ...]:
    """Insults at someone, with letters spaced out, with letters masked, in capitals."""
    insults = set(INSULTS)
    return (
        bool(_DIRECTED.search(low)),
        any(re.sub(r"\W|_", "", m.group()) in insults for m in _SPACED.finditer(low)),
        any(m.group().translate(_PLAIN) in insults for m in _MASKED.finditer(low)),
        any(w.upper() in text for w in INSULTS if w in low),
    )


def terms_of(word: str) -> list[str]:
    """A word as a term, and the openings that it goes on from (written with a dash)."""
    if len(word) > LONGEST:
        return []
    return [word] + [word[:k] + "-" for k in OPENINGS if len(word) > k]


class Vocabulary:
    """Numbers of the terms; finds those in a text."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.number = {t: k for k, t in enumerate(terms)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"terms": self.terms, "number": self.number, "memo": {}}

    def found(self, text: str) -> tuple[int, dict[int, int], tuple[bool, ...]]:
        """Number of words, times of each term, patterns."""
        low = text.lower()
        words = Counter(_WORD.findall(low))
        times: dict[int, int] = {}
        memo = self.memo
        for word, n in words.items():
            own = memo.get(word)
            if own is None:
                own = tuple(self.number[t] for t in terms_of(word) if t in self.number)
                if len(memo) >= MEMO:
                    memo.clear()
                if len(word) <= LONGEST:
                    memo[word] = own
            for k in own:
                times[k] = times.get(k, 0) + n
        return sum(words.values()), times, patterns(text, low)


# ---------------------------------------------------------------- label model


@dataclass
class LabelModel:
    """P(class) and, per voter, P(speaks | parent speaks or not, class) along a forest of correlated voters.

    A silent voter abstains and says nothing; that no voter for toxicity speaks is a voter of its own.
    """

    prior: float
    parent: np.ndarray
    speaks: np.ndarray  # voter x parent's vote x class
    accuracy: np.ndarray  # voter x class: how often it speaks

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        out = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j, p in enumerate(self.parent):
            given = votes[:, p].astype(int) if p >= 0 else np.zeros(len(votes), int)
            chance = self.speaks[j][given]
            out += np.where(votes[:, j], np.log(chance[:, 1] / chance[:, 0]), 0.0)
        return out


def correlated(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Parent of each voter (-1: none) in the forest of greatest information between voters within a class.

    ``weight`` has a column per class. Pairs whose information could be chance are not joined.
    """
    m = votes.shape[1]
    v = votes.astype(np.float64)
    information = np.zeros((m, m))
    for y in (0, 1):
        a = weight[:, y]
        both, own, total = v.T @ (a[:, None] * v), v.T @ a, a.sum()
        i, j = own[:, None], own[None, :]
        for seen, left, right in (
            (both, i, j), (i - both, i, total - j), (j - both, total - i, j), (total - i - j + both, total - i, total - j),
        ):
            expected = np.maximum(left * right / max(total, 1e-9), 1e-9)
            seen = np.maximum(seen, 0)
            information += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0.0)
    np.fill_diagonal(information, 0)
    parent = np.full(m, -1)
    joined = np.zeros(m, bool)
    best, link = np.full(m, -1.0), np.full(m, -1)
    for _ in range(m):  # Prim's algorithm; a tree starts anew where no edge is strong enough
        j = int(np.argmax(np.where(joined, -np.inf, best)))
        joined[j] = True
        if best[j] >= EDGE_G2:
            parent[j] = link[j]
        closer = information[j] > best
        best, link = np.where(closer, information[j], best), np.where(closer, j, link)
    return parent


def fit_labels(
    votes: np.ndarray, label: np.ndarray, weight: np.ndarray, opening: np.ndarray, against: int = 0
) -> tuple[LabelModel, np.ndarray]:
    """Label model and posterior of each row; ``label`` is -1 where unknown, ``opening`` the first guess there.

    The last ``against`` voters speak where the others are silent. They follow from them, so they stay out of the
    forest, each one after the first under the one before it. The share of the classes is that of the labelled rows,
    or of the first guess where none is labelled: silence being no evidence, the rounds cannot estimate it.
    """
    known = label >= 0
    of = label == 1 if known.any() else opening
    heard = weight * known if known.any() else weight
    prior = float((heard @ of + 1) / (heard.sum() + 2))
    others = votes.shape[1] - against
    evidence = np.select(
        [label == 1, label == 0], [np.log(LABEL_HIT / LABEL_FALSE), np.log((1 - LABEL_HIT) / (1 - LABEL_FALSE))], 0.0
    )
    q = np.select([label == 1, label == 0], [LABEL_HIT, LABEL_FALSE], opening)
    model = None
    for turn in range(ROUNDS):
        classes = weight[:, None] * np.stack([1 - q, q], axis=1)
        total = classes.sum(axis=0)
        if turn % 5 == 0:  # the first rounds take voters as independent, as their guess of the class is rough
            forest = correlated(votes[:, :others], classes) if turn else np.full(others, -1)
            parent = np.concatenate([forest, [-1, *range(others, votes.shape[1])][:against]]).astype(int)
        own = votes.T.astype(np.float64) @ classes
        base = (own.sum(axis=1) + 0.5) / (total.sum() + 1)  # a voter that is never heard says nothing
        speaks = np.zeros((votes.shape[1], 2, 2))
        for j, p in enumerate(parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), bool)
            for b in (0, 1):
                rows = given == bool(b)
                heard, n = votes[rows, j].astype(np.float64) @ classes[rows], classes[rows].sum(axis=0)
                speaks[j, b] = (heard + 2 * base[j]) / (n + 2)
        model = LabelModel(prior, parent, np.clip(speaks, 1e-6, 1 - 1e-6), (own + base[:, None]) / (total + 1))
        q = 1 / (1 + np.exp(-np.clip(model.log_odds(votes) + evidence, -40, 40)))
    return model, q


# ---------------------------------------------------------------- classifier


@dataclass
class Sparse:
    """A matrix by its entries; most texts hold few of the terms."""

    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def dot(self, b: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * b[self.col], self.shape[0])

    def tdot(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * v[self.row], self.shape[1])


def fit_linear(x: Sparse, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on soft targets; Newton steps by conjugate gradients."""
    penalty = np.append(np.full(x.shape[1], PENALTY), 1e-3)
    beta = np.zeros(len(penalty))

    def times(b):
        return x.dot(b[:-1]) + b[-1]

    def back(v):
        return np.append(x.tdot(v), v.sum())

    def loss(b):
        z = times(b)
        return float(weight @ (np.logaddexp(0, z) - target * z) + (penalty * b * b).sum() / 2)

    now = loss(beta)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(times(beta), -40, 40)))
        slope = back(weight * (p - target)) + penalty * beta
        curve = weight * np.maximum(p * (1 - p), 1e-9)
        step, r = np.zeros_like(beta), -slope
        d, rr = r.copy(), float(r @ r)
        for _ in range(50):
            if rr <= 1e-16 + 1e-6 * float(slope @ slope):
                break
            hd = back(curve * times(d)) + penalty * d
            a = rr / float(d @ hd)
            step += a * d
            r -= a * hd
            rr, old = float(r @ r), rr
            d = r + rr / old * d
        scale = 1.0
        while scale > 1e-4 and (found := loss(beta + scale * step)) > now:
            scale /= 2
        if scale <= 1e-4 or now - found < 1e-7 * max(1.0, now):
            break
        beta, now = beta + scale * step, found
    return beta[:-1], float(beta[-1])


def _strength(n, words):
    return np.log2(1.0 + n) / 4, np.minimum(1.0, 25.0 * n / np.maximum(words, 1))


@dataclass
class Toxicity:
    vocabulary: Vocabulary
    counted: np.ndarray  # weight of a term's times
    dense: np.ndarray  # weight of a term's density
    pattern: np.ndarray
    intercept: float
    voters: list[tuple[str, float, float]] = field(default_factory=list)  # name, P(speaks | toxic), P(speaks | not)

    def score(self, text: str) -> float:
        words, times, seen = self.vocabulary.found(text)
        margin = self.intercept + float(self.pattern @ np.array(seen, float))
        if times:
            at = np.fromiter(times, np.int64, len(times))
            n = np.fromiter(times.values(), np.float64, len(times))
            a, b = _strength(n, words)
            margin += float(self.counted[at] @ a + self.dense[at] @ b)
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


LEVELS = ("once", "twice", "dense")


def _speaks(times: np.ndarray, words: np.ndarray, level: str) -> np.ndarray:
    """Whether a term stands in a text at all, at least twice, or twice and once in ``DENSE`` words."""
    if level == "dense":
        return (times >= 2) & (times * DENSE >= words)
    return times >= 1 + (level == "twice")


def _induced(times: Sparse, words: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[tuple[int, str]]:
    """(term, level) of voters, chosen one by one for the toxic rows that those before leave uncovered."""
    toxic, clean = label == 1, label == 0
    if not toxic.any():
        return []
    terms = times.shape[1]

    def heard(rows, spoken, of):
        own = spoken & rows[times.row]
        return np.bincount(times.col[own], of[times.row[own]], terms)

    spoken = [_speaks(times.value, words[times.row], level) for level in LEVELS]
    odds = [
        np.log((heard(toxic, s, weight) + 0.5) / (weight[toxic].sum() + 1))
        - np.log((heard(clean, s, weight) + 0.5) / (weight[clean].sum() + 1))
        for s in spoken
    ]
    left, out = weight * toxic, []
    while len(out) < VOTERS:
        gains = [np.where(o > 1, heard(toxic, s, left) * o, 0.0) for s, o in zip(spoken, odds, strict=True)]
        b = int(np.argmax([g.max(initial=0) for g in gains]))
        j = int(np.argmax(gains[b]))
        if gains[b][j] < 3:
            break
        out.append((j, LEVELS[b]))
        left[times.row[spoken[b] & (times.col == j)]] /= 2
        odds[b][j] = 0
    return out


def fit(vocabulary: Vocabulary, times: Sparse, words: np.ndarray, seen: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Toxicity:
    """Voters, label model and classifier from the sample's counts (rows x terms)."""
    fixed = [(vocabulary.number[w], "once") for w in INSULTS]
    chosen = list(dict.fromkeys(fixed + _induced(times, words, label, weight)))
    n, k = times.shape
    heard, hits = np.zeros((n, len(chosen)), bool), np.zeros(n)
    for v, (j, level) in enumerate(chosen):
        own = (times.col == j) & _speaks(times.value, words[times.row], level)
        heard[times.row[own], v] = True
        hits[times.row[own]] += times.value[own]
    quiet, thin = ~heard.any(axis=1), hits * 300 < words
    votes = np.column_stack([heard, seen, quiet, thin])
    names = [f"{vocabulary.terms[j]} {level}" for j, level in chosen] + [*PATTERNS, "quiet", "thin"]
    opening = np.where(heard[:, : len(fixed)].any(axis=1) | seen.any(axis=1), 0.9, 0.02)
    labels, target = fit_labels(votes, label, weight, opening, against=2)
    a, b = _strength(times.value, words[times.row])
    row, pattern = np.nonzero(seen)
    x = Sparse(
        np.concatenate([times.row, times.row, row]), np.concatenate([times.col, times.col + k, pattern + 2 * k]),
        np.concatenate([a, b, np.ones(len(row))]), (n, 2 * k + len(PATTERNS)),
    )
    beta, intercept = fit_linear(x, target, weight)
    voters = [(name, float(p1), float(p0)) for name, (p0, p1) in zip(names, labels.accuracy, strict=True)]
    return Toxicity(vocabulary, beta[:k], beta[k : 2 * k], beta[2 * k :], intercept, voters)


# ---------------------------------------------------------------- Spark


def held_out():
    """Whether a document's labels are kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def sample_of(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, label (-1: unknown), weight and text of a bounded sample of documents that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic is not null")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("label"))
    )
    own = texts(documents)
    ids = own.select("doc_id").filter("doc_id is not null").filter(~held_out())
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    count = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    parts = [
        known.filter(F.col("label") == label).orderBy(order, "doc_id").limit(rows)
        .withColumn("weight", F.lit(max(1.0, count.get(label, 0) / rows)))
        for label, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    ]
    pool = ids.distinct().orderBy(order, "doc_id").limit(OTHER_ROWS).join(known.select("doc_id"), "doc_id", "left_anti")
    parts.append(pool.select("doc_id", F.lit(-1).alias("label"), F.lit(1.0).alias("weight")))
    chosen = parts[0].unionByName(parts[1]).unionByName(parts[2])  # at most 20,000 rows: safe to broadcast
    found = own.join(F.broadcast(chosen), "doc_id")
    least = found.groupBy("doc_id", "label", "weight").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return written(least, "toxicity-sample")


def induced_terms(sample: DataFrame) -> list[str]:
    """The terms that tell toxic from other labelled documents most surely, by the likelihood ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def batch_of():
            rows = np.array(list(seen.values()), np.int64).reshape(-1, 4)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), *(pa.array(rows[:, k]) for k in range(4))],
                names=["term", "c1", "t1", "c2", "t2"],
            )

        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text"), strict=True):
                times: Counter = Counter()
                for word, n in Counter(_WORD.findall(text.as_py().lower())).items():
                    for t in terms_of(word):
                        times[t] += n
                for t, n in times.items():
                    row = seen.setdefault(t, [0, 0, 0, 0])
                    row[label] += 1
                    row[2 + label] += n > 1
                if len(seen) > 500_000:
                    yield batch_of()
                    seen.clear()
        yield batch_of()

    labelled = sample.filter("label >= 0")
    size = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return []
    sums = (
        labelled.select("label", "text")
        .mapInArrow(count, "term string, c1 long, t1 long, c2 long, t2 long")
        .groupBy("term")
        .agg(*(F.sum(c).alias(c) for c in ("c1", "t1", "c2", "t2")))
    )

    def surprise(t, c):
        share = (t + c) / (n_toxic + n_clean)
        cells = ((t, n_toxic * share), (c, n_clean * share), (n_toxic - t, n_toxic * (1 - share)), (n_clean - c, n_clean * (1 - share)))
        g2 = sum((F.when(seen > 0, seen * F.log(seen / F.greatest(want, F.lit(1e-9)))).otherwise(0.0) for seen, want in cells), F.lit(0.0))
        return F.when((t >= 3) & (t * n_clean > c * n_toxic), 2 * g2).otherwise(0.0)

    scored = sums.withColumn("g2", F.greatest(surprise(F.col("t1"), F.col("c1")), surprise(F.col("t2"), F.col("c2"))))
    best = scored.filter(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "term").limit(TERMS)
    return [r.term for r in best.select("term").collect()]


def train(documents: DataFrame, labels: DataFrame) -> Toxicity:
    """Voters, label model and classifier from the sample; the driver holds its counts (20,000 rows at most)."""
    sample = sample_of(documents, labels)
    vocabulary = Vocabulary(list(dict.fromkeys(INSULTS + induced_terms(sample))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vocabulary.found(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("label"), batch.column("weight"), pa.array([f[0] for f in found], pa.int64()),
                    pa.array([list(f[1]) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f[1].values()) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f[2]) for f in found], pa.list_(pa.bool_())),
                ],
                names=["doc_id", "label", "weight", "words", "terms", "times", "seen"],
            )

    schema = "doc_id long, label int, weight double, words long, terms array<int>, times array<int>, seen array<boolean>"
    rows = sample.mapInArrow(measure, schema).toArrow().sort_by("doc_id")  # one row per document of the sample
    if not len(rows):
        nothing = np.zeros(len(vocabulary.terms))
        return Toxicity(vocabulary, nothing, nothing, np.zeros(len(PATTERNS)), -np.inf)
    column = {c: rows[c].combine_chunks() for c in rows.column_names}
    terms = column["terms"]
    row = np.repeat(np.arange(len(rows)), terms.value_lengths().to_numpy())
    times = Sparse(
        row, terms.flatten().to_numpy().astype(np.int64), column["times"].flatten().to_numpy().astype(np.float64),
        (len(rows), len(vocabulary.terms)),
    )
    seen = np.array(column["seen"].flatten()).astype(bool).reshape(len(rows), len(PATTERNS))
    words, label, weight = (column[c].to_numpy() for c in ("words", "label", "weight"))
    return fit(vocabulary, times, words, seen, label, weight)


def scored(documents: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id and score of each document; one pass without a shuffle."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return texts(documents).mapInArrow(score, "doc_id long, score double")


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score and decision of each document by a model trained here."""
    return scored(documents, train(documents, labels)).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def query(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
