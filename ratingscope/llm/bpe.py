"""Byte-level BPE encoding and decoding with a public vocabulary of ranks.

Bytes are read as Latin-1 characters, so that a pyahocorasick trie finds the longest token at
any place. From that match the encoder walks on as long as neighbouring
tokens are compatible, that is, as long as merging the bytes of the two by rank gives just
these two; otherwise it tries the next shorter token, or steps back over the last one and
marks the place as dead. A sequence whose neighbours are all compatible is the one the
merges give, and each place dies once at most, so the time is linear in the piece.

Edge cases. Null and empty texts have no tokens. A piece that is a token is that token, as in
the tiktoken library. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Pieces and token pairs that a worker remembers, within a text too. Of pieces it keeps the last two generations
# of this many, so frequent ones stay; of pairs it forgets all and goes on.
MEMO, MEMO_PAIRS = 80_000, 250_000
# Pieces longer than this are not remembered.
MEMO_LENGTH = 64
# Bytes of text whose ids a worker gathers before it hands them on.
HANDED = 2 << 20


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.bytes_of = tokens_of(ranks)
        self.size_of = list(map(len, self.bytes_of))
        self.trie = ahocorasick.Automaton()
        self.most = max(self.size_of)
        # The longest proper prefix of a token that is a token too.
        self.shorter: list[int | None] = [None] * len(self.bytes_of)
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), rank)
            self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None)
        self.fitting: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The plain merges of a few bytes: the pair of lowest rank first, leftmost first."""
        rank, none = self.ranks.get, len(self.bytes_of)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self.fitting.get(pair)
        if known is None:
            if len(self.fitting) >= MEMO_PAIRS:
                self.fitting.clear()
            both = self.bytes_of[left] + self.bytes_of[right]
            known = both not in self.ranks and self.merged(both) == [left, right]
            self.fitting[pair] = known
        return known

    def encode_bytes(self, data: bytes) -> list[int]:
        """Tokens of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size_of, shorter, rank, most = self.size_of, self.shorter, self.ranks.get, self.most
        text, reach, fitting = data.decode("latin-1"), self.trie.longest_prefix, self.fitting
        dead = bytearray(len(data) + 1)
        tokens: list[int] = []
        at, token, last = 0, None, None
        while at < len(data):
            if token is None:
                # The trie tells how far some token agrees; the longest whole one ends there or before.
                size = reach(text[at : at + most])
                while (token := rank(data[at : at + size])) is None:
                    size -= 1
            while token is not None:
                end = at + size_of[token]
                if not dead[end]:
                    if last is None:
                        break
                    fit = fitting.get((last, token))
                    if fit or (fit is None and self.fits(last, token)):
                        break
                token = shorter[token]
            if token is None:
                dead[at] = 1
                token = tokens.pop()
                at -= size_of[token]
                last = tokens[-1] if tokens else None
            else:
                tokens.append(token)
                at, last, token = end, token, None
        return tokens

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        known = self.older.get(piece) or tuple(self.encode_bytes(piece.encode("utf-8")))
        if len(piece) <= MEMO_LENGTH:
            if len(self.pieces) >= MEMO:
                self.older = self.pieces.copy()
                self.pieces.clear()
            self.pieces[piece] = known
        return known

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get, make = self.pieces.get, self.encode_piece
        return list(chain.from_iterable([get(p) or make(p) for p in self.split(text)]))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    """Bytes by rank."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Bpe:
    """The encoder of the vocabulary at ``path``, once in each worker."""
    return Bpe(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def load_tokens(path: str) -> list[bytes]:
    """All a decoder needs."""
    return tokens_of(read_ranks(path))


def decode(ids: list[int], tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def _encoded(texts: Iterator[pa.Array], bpe: Bpe) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and the bytes they decode to, for HANDED bytes of text or so at a time."""
    for batch in texts:
        ids, back, held = [], [], 0
        for text in batch:
            found = bpe.encode(text.as_py())
            back.append(decode(found, bpe.bytes_of))
            ids.append(np.array(found, dtype=np.int32))
            held += len(back[-1])
            if held >= HANDED:
                yield _lists(ids), back
                ids, back, held = [], [], 0
        if ids:
            yield _lists(ids), back


def encode_text(text: Column, path: str, pattern: str) -> Column:
    """Token ids, ``array<int>``. ``path`` is a vocabulary installed on every machine."""

    @F.arrow_udf("array<int>")
    def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found, _ in _encoded(texts, load(path, pattern)):
            yield found

    return ids(text)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def encode_and_decode(text: Column, path: str, pattern: str) -> Column:
    """Token ids and the bytes they decode to, in one worker: ``struct<ids, decoded>``."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found, back in _encoded(texts, load(path, pattern)):
            yield pa.StructArray.from_arrays([found, pa.array(back, type=pa.binary())], names=["ids", "decoded"])

    return both(text)


def decode_ids(ids: Column, path: str) -> Column:
    """The bytes that token ids stand for, ``binary``."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = load_tokens(path)
        for batch in batches:
            yield pa.array([decode(x.values.to_pylist(), tokens) if x.is_valid else b"" for x in batch], type=pa.binary())

    return decoded(ids)
