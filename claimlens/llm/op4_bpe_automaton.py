"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its arc labels.

``compile_automaton`` starts with one state that every byte token loops on and applies a merge gadget for each
merge in order. The gadget for ``u v -> w`` copies the state that ``u`` enters, takes the arc ``v`` out of the
copy, lets ``u`` enter the copy instead, and adds an arc ``w`` wherever ``u`` has one, into the state that
``v`` enters. A path of the finished automaton is the token sequence that the merges make of the text along
its labels, and each text has one path. ``encode_word`` walks it left to right through the tables.

Defined results: a null or empty text has no tokens. Special tokens of the vocabulary file are cut out of a
text first and keep their ids. Texts of any length are encoded whole; words are cached up to a size that
bounds a worker's memory, longer words and full caches only cost time. Repeated rows give repeated results;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

# fixed value: how byte-level vocabularies split a text into words
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHED_WORD_CHARS = 64
CACHED_WORDS = 300_000
NEVER = 1 << 62
AFTER = NEVER + 1


def printable_bytes() -> dict[str, int]:
    """The characters that byte-level vocabulary files write for bytes: themselves if printable, else from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Automaton:
    """Tables of the compiled automaton; their size follows the vocabulary only."""

    labels: list[bytes]  # text along the arc of each token id
    enter: dict[int, int]  # state that a token's arc enters
    spine: dict[int, tuple]  # a token, its left part, that one's left part ...; each with the merge that used it
    gone: list[dict[int, int]]  # per state: arcs taken out, with the merge that took them
    goto: dict[int, int]  # trie over the labels: node * 256 + byte -> node
    accept: dict[int, int]  # trie node -> token
    special: list[tuple[str, int]]

    def allows(self, state: int, token: int) -> bool:
        """Whether the state has an arc for the token: an arc is missing if it, or the left part that it came
        from, had been taken out by the time it was added."""
        gone = self.gone[state]
        return not any(gone.get(part, AFTER) <= before for part, before in self.spine[token])

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Tokens of one pre-split word: a walk that takes the longest arc first and turns back at dead ends.
        Each prefix has one path, so a position that led nowhere is never entered again."""
        n = len(word)
        goto, accept, gone, spine, enter = self.goto, self.accept, self.gone, self.spine, self.enter
        path: list[int] = []
        waiting: list[list[tuple[int, int]]] = []  # per token of the path and the next one: arcs not yet tried
        dead: set[int] = set()
        at, state = 0, 0
        while at < n:
            arcs, node = [], 0
            for end in range(at, n):
                node = goto.get(node << 8 | word[end])
                if node is None:
                    break
                token = accept.get(node)
                if token is not None:
                    arcs.append((token, end + 1))
            waiting.append(arcs)
            while True:
                arcs = waiting[-1]
                if arcs:
                    token, end = arcs.pop()
                    if end in dead:
                        continue
                    taken = gone[state]
                    if taken:
                        for part, before in spine[token]:
                            if taken.get(part, AFTER) <= before:
                                break
                        else:
                            path.append(token)
                            at, state = end, enter[token]
                            break
                        continue
                    path.append(token)
                    at, state = end, enter[token]
                    break
                waiting.pop()
                dead.add(at)
                at -= len(self.labels[path.pop()])
                state = enter[path[-1]] if path else 0
        return tuple(path)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


def compile_automaton(n_ids: int, bytes_of: dict[int, bytes], merges: list[tuple[int, int, int]], special=()) -> Automaton:
    """``bytes_of``: labels of the byte tokens; ``merges``: (left, right, made) in order of priority."""
    labels: list[bytes] = [b""] * n_ids
    enter: dict[int, int] = {}
    spine: dict[int, tuple] = {}
    gone: list[dict[int, int]] = [{}]
    for token, label in bytes_of.items():
        labels[token], enter[token], spine[token] = label, 0, ((token, NEVER),)
    a = Automaton(labels, enter, spine, gone, {}, {}, sorted(special, key=lambda x: -len(x[0])))
    for k, (u, v, w) in enumerate(merges):
        if w in spine:
            raise ValueError("a token is made by two merges")
        labels[w] = labels[u] + labels[v]
        if u not in enter or v not in enter:
            continue
        fork, beyond = enter[u], enter[v]
        if not a.allows(fork, v):  # u and v never meet, so no path has w
            continue
        gone.append(gone[fork] | {v: k})
        enter[u] = len(gone) - 1
        enter[w], spine[w] = beyond, ((w, NEVER), (u, k), *spine[u][1:])
    nodes = 1
    for token in enter:
        node = 0
        for b in labels[token]:
            step = node << 8 | b
            if step not in a.goto:
                a.goto[step] = nodes
                nodes += 1
            node = a.goto[step]
        a.accept[node] = token
    for text, token in special:
        labels[token] = text.encode()
    return a


def load(path: str) -> Automaton:
    """The automaton of a byte-level vocabulary file (JSON with vocab, merges and added tokens)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    chars = printable_bytes()
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    special = [(t["content"], t["id"]) for t in spec.get("added_tokens", [])]
    n = max([*vocab.values(), *(i for _, i in special)]) + 1
    return compile_automaton(
        n,
        {vocab[c]: bytes([b]) for c, b in chars.items() if c in vocab},
        [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs],
        special,
    )


class _Words(dict):
    """Word -> ids, filled by the automaton."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.own = list(range(len(automaton.labels)))  # one object per id

    def __missing__(self, word: str):
        ids = tuple(map(self.own.__getitem__, self.automaton.encode_word(word.encode("utf-8", "surrogatepass"))))
        if len(word) <= CACHED_WORD_CHARS:
            self[word] = ids
        return ids


class _Chunks(dict):
    """Text between single spaces -> ids."""

    def __init__(self, words: _Words, find):
        self.words, self.find = words, find

    def __missing__(self, chunk: str):
        ids = tuple(chain.from_iterable(map(self.words.__getitem__, self.find(chunk))))
        if len(chunk) <= CACHED_WORD_CHARS:
            self[chunk] = ids
        return ids


class Encoder:
    """Encodes whole texts: special tokens, pre-split words, automaton."""

    # a space between white space and white space or the end belongs to a longer word
    _joined = re.compile(r"\s (?:\s|\Z)")

    def __init__(self, automaton: Automaton):
        import regex

        self.automaton = automaton
        self.special = dict(automaton.special)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        find = regex.compile(SPLIT).findall
        self.words = _Words(automaton)
        self.chunks = _Chunks(self.words, find)
        self.decimal = [str(k) for k in range(len(automaton.labels))]

    def _plain(self, text: str):
        if self._joined.search(text):
            return map(self.words.__getitem__, self.chunks.find(text))
        # a space after and before other characters always starts a word, so texts may be cut there
        first, *rest = text.split(" ")
        return map(self.chunks.__getitem__, [first, *(" " + x for x in rest)] if first else [" " + x for x in rest])

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if self.cut is None or not any(s in text for s in self.special):
            return list(chain.from_iterable(self._plain(text)))
        out: list[int] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(chain.from_iterable(self._plain(part)))
        return out

    def trim(self) -> None:
        for cache in (self.words, self.chunks):
            if len(cache) > CACHED_WORDS:
                cache.clear()


_ENCODERS: dict[str, Encoder] = {}


def encoded_digests(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts; one pass without a shuffle.

    The compiled tables are broadcast: their size is that of the vocabulary, whatever the input.
    """
    tables = documents.sparkSession.sparkContext.broadcast(load(vocabulary))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = Encoder(tables.value)
        encoder = _ENCODERS[vocabulary]
        decimal, decode, sha = encoder.decimal, encoder.automaton.decode, hashlib.sha256
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for text in batch.column("text"):
                ids = encoder.encode(text.as_py() or "")
                counts.append(len(ids))
                ids_hash.append(sha(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_hash.append(sha(decode(ids).decode("utf-8", "replace").encode()).hexdigest())
            encoder.trim()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    from claimlens.llm.common import texts

    return texts(documents).mapInArrow(digest, SCHEMA)


def query(spark, sf_dir):
    import public_tokenizers

    from claimlens.llm.common import table

    return encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
