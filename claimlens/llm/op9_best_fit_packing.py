"""Vector best-fit packing of tokenized documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths). A
piece of length L asks for (L, 1, L * L). Pieces go longest first; each goes to the open sequence that it fits
under every capacity and that scores best, by the smallest weighted norm of what stays free (``residual``) or
the largest weighted dot product of demand and free room (``dot``); if none has room, a new one is opened.

What a piece asks for depends on its length alone, so the packing depends on the histogram of lengths, which
has at most ``max_tokens`` rows whatever the input. The plan is made from it with runs of equal sequences
taken together, and names ranges of ranks within a length. The table then gets its ranks from counts per
(input partition, length), and each piece looks its place up; no piece meets another in a task. All pieces
are packed by one plan, so the result is that of a single best-fit run over the whole corpus.

Defined results: a null or empty text is one piece with the closing id. Only documents longer than
``max_tokens`` are cut. Repeated rows are packed once each; a null doc_id stays null; other columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import table, text_slices, texts, written

CLOSING_ID = 0
CACHED_CHUNKS, CACHED_IDS, SLICE_BYTES = 500_000, 4_000_000, 4 << 20
CHUNKS_AT_ONCE = 500
GATHERED_CHUNKS = 100_000  # whose ids are gathered together

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


# ---------------------------------------------------------------- tokens


class ChunkTokens:
    """Ids of whole texts by the tokenizers library, many texts at a time.

    The vocabulary's normaliser and word pattern never look across white space, and a full stop or comma between an ASCII
    letter and white space is a word of its own. So texts are cut at blanks, line ends and there, each different
    chunk is encoded once, and the ids are gathered by chunk number. New chunks are encoded many at a time, with a
    comma between them whose id tells where one ends. Chunks stay known until there are ``CACHED_CHUNKS`` of them or
    ``CACHED_IDS`` ids. Chunks that might hold a special token keep their capitals.
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        (self.comma,) = self._encode(",")
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.flat, self.starts, self.lengths = array("I"), array("i", [0]), array("i", [0])

    def _encode(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def _add(self, chunks: list[str], ids: np.ndarray, first: np.ndarray, n: np.ndarray) -> None:
        self.number.update(zip(chunks, range(len(self.starts), len(self.starts) + len(chunks)), strict=True))
        self.starts.frombytes((first + len(self.flat)).astype(np.int32).tobytes())
        self.lengths.frombytes(n.astype(np.int32).tobytes())
        self.flat.frombytes(ids.tobytes())

    def _learn(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if "," not in c]
        for at in range(0, len(plain), CHUNKS_AT_ONCE):
            some = plain[at : at + CHUNKS_AT_ONCE]
            ids = self._encode(" , ".join([*some, ""]))
            ends = np.flatnonzero(ids == self.comma)
            first = np.concatenate([[0], ends[:-1] + 1])
            self._add(some, ids, first, ends - first)
        for chunk in chunks:
            if "," in chunk:
                ids = self._encode(chunk)
                self._add([chunk], ids, np.zeros(1, np.int64), np.array([len(ids)]))

    def _numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The chunk numbers of some texts, and where each text's end."""
        apart = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), "([A-Za-z])([.,])( |$)", r"\1 \2\3")
        parts = pc.split_pattern(apart, " ")
        at = parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()
        words = parts.flatten()
        if pc.any(pc.match_substring(texts, "<")).as_py():
            words = pc.if_else(pc.match_substring(words, "<"), words, pc.ascii_lower(words))
        else:
            words = pc.ascii_lower(words)
        encoded = pc.dictionary_encode(words)
        chunks, places = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
        del apart, parts, words, encoded
        if len(self.number) > CACHED_CHUNKS or len(self.flat) > CACHED_IDS:
            self._forget()
        codes = np.fromiter(map(self.number.get, chunks, repeat(-1)), np.int32, len(chunks))
        absent = np.flatnonzero(codes < 0)
        new = [chunks[k] for k in absent.tolist()]
        self._learn(new)
        codes[absent] = np.fromiter(map(self.number.__getitem__, new), np.int32, len(new))
        pa.default_memory_pool().release_unused()  # workers stay alive between tasks
        return codes[places], at

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some chunks, and where each chunk's end, after a 0."""
        flat = np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32)  # freed here, as the array must grow
        starts, counts = np.frombuffer(self.starts, np.int32)[codes], np.frombuffer(self.lengths, np.int32)[codes]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total, dtype=np.int32 if total < 1 << 31 else np.int64)
        index += np.repeat((starts - ends + counts).astype(index.dtype), counts)
        return flat[index], np.concatenate([[0], ends])

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and where each text's ids end."""
        codes, at = self._numbers(texts)
        ids, ends = self._gather(codes)
        return ids, ends[at]

    def runs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``batch``, for some texts after the other, of about ``GATHERED_CHUNKS`` chunks; a longer text is a run of its own."""
        codes, at = self._numbers(texts)
        start = 0
        while start < len(at):
            before = int(at[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(at, before + GATHERED_CHUNKS, "right")))
            ids, ends = self._gather(codes[before : at[stop - 1]])
            yield ids, ends[at[start:stop] - before]
            start = stop


_TOKENS: dict[str, ChunkTokens] = {}


def tokenized_pieces(documents: DataFrame, vocabulary: str, max_tokens: int = 2048) -> DataFrame:
    """Pieces with their input partition and their rank among the pieces of their length in it."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = documents.sparkSession.sparkContext.broadcast(f.read())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _TOKENS:
            _TOKENS[vocabulary] = ChunkTokens(spec.value)
        tokens, part, seen = _TOKENS[vocabulary], TaskContext.get().partitionId(), Counter()
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        for batch in batches:
            rows, keys = [], iter(batch.column("doc_id").to_pylist())
            slices = text_slices(pc.fill_null(batch.column("text"), ""), SLICE_BYTES)
            for every, ends in chain.from_iterable(map(tokens.runs, slices)):
                data, at = memoryview(every.astype("<u4", copy=False)).cast("B"), 0
                for end in ends.tolist():
                    doc_id, n = next(keys), end - at + 1
                    for piece, start in enumerate(range(0, n, max_tokens)):
                        length = min(max_tokens, n - start)
                        crc = zlib.crc32(data[4 * (at + start) : 4 * min(at + start + length, end)])
                        if start + length == n:
                            crc = zlib.crc32(closing, crc)
                        rows.append((doc_id, piece, start, length, crc, part, seen[length]))
                        seen[length] += 1
                    at = end
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    return texts(documents).mapInArrow(cut, PIECES)


# ---------------------------------------------------------------- plan


@dataclass(frozen=True)
class Capacity:
    """Room of a sequence. By default documents and attention cost bind no earlier than tokens can."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.1)
    rule: str = "residual"

    def room(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.attention or self.tokens * self.tokens], dtype=np.int64
        )


@dataclass
class Plan:
    """Ranks [first_rank, next row's first_rank) of a length go to sequences first_sequence, +1, ... at offset."""

    length: np.ndarray
    first_rank: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fit_plan(histogram: dict[int, int], capacity: Capacity = Capacity()) -> Plan:
    """Vector best fit over a histogram of lengths. Sequences of one history are held as a run."""
    full = capacity.room()
    weight = np.array(capacity.weights) / np.maximum(full, 1)
    size = 1024
    free, count, base = np.zeros((size, 3), np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    runs = sequences = 0
    rows: list[tuple[int, int, int, int]] = []

    def add(room, n, first):
        nonlocal runs, size, free, count, base
        if n == 0 or room[0] == 0:
            return
        if runs == size:
            live = np.flatnonzero(count[:runs])
            size = max(1024, 2 * len(live))
            f, c, b = np.zeros((size, 3), np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            runs = len(live)
            f[:runs], c[:runs], b[:runs] = free[live], count[live], base[live]
            free, count, base = f, c, b
        free[runs], count[runs], base[runs] = room, n, first
        runs += 1

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        ask = np.array([length, 1, length * length], dtype=np.int64)
        if (ask > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            fits = np.flatnonzero((free[:runs] >= ask).all(axis=1) & (count[:runs] > 0))
            if len(fits):
                rest = (free[fits] - ask) * weight
                score = (rest * rest).sum(axis=1) if capacity.rule == "residual" else -(free[fits] * weight * ask * weight).sum(axis=1)
                best = fits[np.argmin(score)]
                room, n, first = free[best].copy(), int(count[best]), int(base[best])
                count[best] = 0
            else:
                room, first = full, sequences
                n = -(-left // int((full // ask).min()))
                sequences += n
            # after a piece the same sequence has least room and stays the best, so it takes what it can
            each = int((room // ask).min())
            filled = min(n, left // each)
            for k in range(each if filled else 0):
                rows.append((length, rank, first, int(full[0] - room[0]) + k * length))
                rank += filled
            left -= each * filled
            add(room - each * ask, filled, first)
            first, n = first + filled, n - filled
            if n and left:  # fewer pieces than one sequence takes
                for k in range(left):
                    rows.append((length, rank, first, int(full[0] - room[0]) + k * length))
                    rank += 1
                add(room - left * ask, 1, first)
                left, first, n = 0, first + 1, n - 1
            add(room, n, first)
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    order = np.lexsort((columns[1], columns[0]))
    return Plan(*(c[order] for c in columns), sequences)


# ---------------------------------------------------------------- places


def placed(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """Sequence and offset of each piece. ``pieces`` is read more than once: hand over a written table."""
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unique(plan.length)
        starts, ends = np.searchsorted(plan.length, known), np.searchsorted(plan.length, known, side="right")
        bounds = {int(n): (int(a), int(b)) for n, a, b in zip(known, starts, ends, strict=True)}
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = np.empty(len(batch), np.int64)
            for n in np.unique(length):
                a, b = bounds[int(n)]
                own = length == n
                row[own] = a + np.searchsorted(plan.first_rank[a:b], rank[own], side="right") - 1
            batch["sequence_id"] = plan.first_sequence[row] + rank - plan.first_rank[row]
            batch["offset"] = plan.offset[row]
            batch["doc_id"] = pd.array(batch["doc_id"], "Int64")
            yield batch.drop(columns="rank")

    return ranked.mapInPandas(look_up, PLACED)


def pack(documents: DataFrame, vocabulary: str, capacity: Capacity = Capacity()) -> DataFrame:
    """Tokenizes and packs a table of documents; the pieces are written once to the shared folder."""
    return placed(written(tokenized_pieces(documents, vocabulary, capacity.tokens), "pieces"), capacity)


def query(spark, sf_dir):
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
