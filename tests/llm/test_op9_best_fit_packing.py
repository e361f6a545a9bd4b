import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimlens.llm import op9_best_fit_packing as op
from llm_helpers import texts_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_cached_ids_equal_the_library(library):
    rnd = random.Random(1)
    with open(PATH, encoding="utf-8") as f:
        tokens = op.ChunkTokens(f.read())
    parts = [
        "a", "The", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u200b", "e\u0301", "É", "ß", "漢", "😀", "<|endoftext|>", "<|ENDOFTEXT|>",
        "'S", "'", "12", "a,b", "end.", "END,", "x.y", "1.", "<a.", "é.", "×,", "½", "Ⅷ", "!", ",", ".", "\r\n", "İ", "ΑΣ", "\u0301", "\u1100", "\u1161", "x" * 60,
    ]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(4000)]
    got = [i for some in op.text_slices(pa.array(texts), 5000) for i in np.split(*batch(tokens, some))]
    assert len(got) == len(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def batch(tokens, some):
    ids, ends = tokens.batch(some)
    return ids, ends[:-1]


def test_slices_hold_every_text_once():
    texts = ["", "a" * 10, "", "é" * 100, "b", ""]
    for most in (1, 12, 1000):
        slices = [s.to_pylist() for s in op.text_slices(pa.array(texts), most)]
        assert sum(slices, []) == texts and all(slices)
    assert list(op.text_slices(pa.array([], pa.string()), 5)) == []


def one_by_one(lengths, capacity):
    """Best fit piece by piece over a list of sequences."""
    full, weight = capacity.room(), np.array(capacity.weights) / capacity.room()
    free = []
    for n in sorted(lengths, reverse=True):
        ask = np.array([n, 1, n * n])
        fits = [i for i, f in enumerate(free) if (f >= ask).all()]
        if fits:
            best = min(fits, key=lambda i: ((((free[i] - ask) * weight) ** 2).sum(), i))
            free[best] = free[best] - ask
        else:
            free.append(full - ask)
    return len(free)


@pytest.mark.parametrize("capacity", [op.Capacity(100), op.Capacity(100, documents=4), op.Capacity(100, attention=3000), op.Capacity(100, rule="dot")])
def test_plan_holds_every_capacity(capacity):
    rnd = random.Random(4)
    histogram = Counter(min(100 if capacity.attention is None else 50, 1 + int(rnd.expovariate(0.06))) for _ in range(3000))
    plan = op.best_fit_plan(histogram, capacity)
    bins = defaultdict(list)
    for n, count in histogram.items():
        own = np.flatnonzero(plan.length == n)
        for rank in range(count):
            row = own[np.searchsorted(plan.first_rank[own], rank, side="right") - 1]
            bins[int(plan.first_sequence[row] + rank - plan.first_rank[row])].append((int(plan.offset[row]), n))
    assert sum(map(len, bins.values())) == 3000 and set(bins) == set(range(plan.sequences))
    room = capacity.room()
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= room[0] and len(pieces) <= room[1] and sum(n * n for _, n in pieces) <= room[2]
    if capacity.rule == "residual":
        alone = one_by_one([n for n, c in histogram.items() for _ in range(c)], capacity)
        assert abs(plan.sequences - alone) <= max(1, alone // 100)
    else:
        assert plan.sequences <= 1.1 * sum(n * c for n, c in histogram.items()) / 100 + 1


def check(df, library, rows):
    want = Counter()
    for doc_id, text in texts_of(df):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[(doc_id, piece, start, len(part), zlib.crc32(array("I", part).tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    return len(bins)


def test_pack(documents, awkward, library):
    rows = op.pack(documents.repartition(3), PATH).collect()
    used = check(documents, library, rows)
    assert used <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    check(awkward, library, op.pack(awkward, PATH).collect())
    assert op.pack(documents.limit(0), PATH).count() == 0


def test_a_piece_beyond_a_capacity_fails():
    with pytest.raises(ValueError):
        op.best_fit_plan({10: 1}, op.Capacity(10, attention=50))


def test_memory_follows_the_slice_not_the_batch():
    """A worker's arrays for a batch of 20 MB, beside the batch itself."""
    import random
    import tracemalloc

    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(3, 9))) for _ in range(20_000)]
    batch = pa.array([" ".join(rnd.choices(words, k=500)) for _ in range(6_000)])
    tokens = op.ChunkTokens(open(PATH, encoding="utf-8").read())
    usual, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    tracemalloc.start()
    try:
        for some in op.text_slices(batch, op.SLICE_BYTES):
            for _ in tokens.runs(some):
                pass
        most = tracemalloc.get_traced_memory()[1] + pool.max_memory()
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(usual)
    assert most < 60 << 20, most


def test_runs_are_the_batch(monkeypatch):
    tokens = op.ChunkTokens(open(PATH, encoding="utf-8").read())
    rnd = random.Random(3)
    some = pa.array(["", "one two"] + [" ".join(rnd.choices(["Ab", "cd.", "", "e,f", "x" * 50], k=rnd.randint(0, 40))) for _ in range(50)])
    ids, ends = tokens.batch(some)
    for most in (1, 30, 100_000):
        monkeypatch.setattr(op, "GATHERED_CHUNKS", most)
        runs = list(tokens.runs(some))
        assert np.concatenate([i for i, _ in runs]).tolist() == ids.tolist()
        assert np.diff(np.concatenate([np.diff(e, prepend=0) for _, e in runs]).cumsum(), prepend=0).tolist() == np.diff(ends, prepend=0).tolist()
