import hashlib
import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from claimlens.llm import op4_bpe_automaton as op
from llm_helpers import texts_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return op.Encoder(op.load(PATH))


def test_random_texts_equal_the_library(library, encoder):
    rnd = random.Random(1)
    parts = [
        "a", "b", "e", "the", " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", "\u200b", "e\u0301", "é", "ß", "漢", "😀", "'s", "'", "'ll",
        "12", "½", "Ⅷ", "!", "..", "\r\n", "\ufeff", "aaaaaaa", "ing", " the", "\u3000", "İ", "<|endoftext|>", "<|end",
    ]
    for text in ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(4000)] + ["a" * 3000, " " * 2000, "ab" * 2000]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert encoder.automaton.decode(ids).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_small_automaton_accepts_just_the_merged_sequences():
    """Over two letters: each text has one path, and it is what applying the merges in order gives."""
    merges = [(0, 1, 2), (0, 0, 3), (3, 2, 4), (1, 1, 5), (5, 5, 6)]
    a = op.compile_automaton(7, {0: b"a", 1: b"b"}, merges)

    def by_merges(ids):
        for u, v, w in merges:
            out, i = [], 0
            while i < len(ids):
                if ids[i : i + 2] == [u, v]:
                    out.append(w)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    for n in range(1, 11):
        for k in range(2**n):
            letters = [k >> i & 1 for i in range(n)]
            assert list(a.encode_word(bytes(97 + x for x in letters))) == by_merges(letters)


def test_digests(documents, awkward, library):
    for df in (documents.limit(60), awkward):
        rows = op.encoded_digests(df, PATH).collect()
        want = []
        for i, text in texts_of(df):
            ids = library.encode(text, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert op.encoded_digests(documents.limit(0), PATH).count() == 0


def test_full_caches_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(op, "CACHED_WORDS", 1)
    text = "The quick brown fox jumps over the lazy dog."
    first = encoder.encode(text)
    encoder.trim()
    assert not encoder.words and encoder.encode(text) == first
