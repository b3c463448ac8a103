"""Exact byte-level BPE by backtracking, in time linear in the text.

Aho-Corasick gives the longest token at a place; it is kept if the place where it ends isn't
known to lead nowhere and the token is compatible with the one before it, that is, if no merge
across their border would have come before the merges that made them. Sequences whose
neighbours are all compatible are exactly the results of the merges, so no merge is replayed.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import regex

#: Fixed value: the pattern that parts text before merging, as published with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A chunk is what the pattern never reaches across: a word with one blank or line end before it.
#: U+001C to U+001F are blanks to `re`, but not to the pattern.
_BLANK, _FILLED = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
CHUNK = re.compile(rf"[ \n]?{_FILLED}+|{_BLANK}+(?!{_FILLED})|{_BLANK}")
MAX_CHUNKS = 200_000
MAX_CACHED_LENGTH = 64


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank, a line each) by id."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    return [ranks[i] for i in range(len(ranks))]


class ByteBpe:
    """An encoder and decoder over the tokens of a rank file."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        names = [t.decode("latin-1") for t in tokens]
        self.id_of = {t: i for i, t in enumerate(names)}
        self.names = names
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(names):
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.widest = max(map(len, tokens))
        self.ends = np.cumsum([0, *map(len, tokens)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._compatible: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int] = {}
        self._spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.pattern = regex.compile(PATTERN)
        self.clear()

    def clear(self) -> None:
        self.chunk_at: dict[str, int] = {}
        self.pool: list[int] = []
        self.starts = [0]
        self.words: dict[str, list[int]] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes `token`; None for single bytes."""
        if token not in self._halves:
            name = self.names[token]
            cuts = [(a, b) for i in range(1, len(name)) if (a := self.id_of.get(name[:i], token)) < token and (b := self.id_of.get(name[i:], token)) < token]
            # The true cut is the one whose halves stand side by side until this very merge.
            self._halves[token] = next((c for c in cuts if len(cuts) == 1 or self._side_by_side(*c, token)), None)
        return self._halves[token]

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces at one border of `token` (side 1: right, 0: left), each with the rank that ends it."""
        key = (token, side)
        if key not in self._spines:
            spine, until = [], float("inf")
            piece: int | None = token
            while piece is not None:
                spine.append((piece, until))
                until = piece
                halves = self.halves(piece)
                piece = halves[side] if halves else None
            self._spines[key] = spine
        return self._spines[key]

    def _side_by_side(self, a: int, b: int, before: float) -> bool:
        for x, x_until in self._spine(a, 1):
            for y, y_until in self._spine(b, 0):
                merge = self.id_of.get(self.names[x] + self.names[y])
                # Equal ranks merge from the left: the border wins over the right piece's own merge.
                if merge is not None and merge < before and merge < x_until and merge <= y_until and self.halves(merge) == (x, y):
                    return False
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether `a` and `b` can be neighbours in an encoding; kept in a table."""
        known = self._compatible.get((a, b))
        if known is None:
            known = self._compatible[a, b] = self._side_by_side(a, b, float("inf"))
        return known

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of `token`, or -1."""
        known = self._shorter.get(token)
        if known is None:
            name = self.names[token]
            known = self._shorter[token] = next((i for n in range(len(name) - 1, 0, -1) if (i := self.id_of.get(name[:n])) is not None), -1)
        return known

    def _longest(self, word: str, at: int) -> int:
        """The longest token that begins at `at`; every single byte is one."""
        return next(self.automaton.iter_long(word[at : at + self.widest]))[1]

    def encode_word(self, word: str) -> list[int]:
        """The ids of one piece of the pattern."""
        w = word.encode().decode("latin-1")
        whole = self.id_of.get(w)
        if whole is not None:
            return [whole]
        n, out, at, dead = len(w), [], 0, bytearray(len(w) + 1)
        token = self._longest(w, 0)
        while True:
            while token >= 0:
                end = at + len(self.names[token])
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = self._longest(w, at)
            else:
                dead[at] = 1
                last = out.pop()
                at -= len(self.names[last])
                token = self.shorter(last)

    def encode_chunk(self, chunk: str) -> list[int]:
        out: list[int] = []
        for word in self.pattern.findall(chunk):
            ids = self.words.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= MAX_CACHED_LENGTH:
                    self.words[word] = ids
            out += ids
        return out

    def _places(self, text: str) -> np.ndarray:
        chunks = CHUNK.findall(text)
        at = self.chunk_at
        try:
            return np.fromiter(map(at.__getitem__, chunks), np.int32, len(chunks))
        except KeyError:
            return np.fromiter((at[c] if c in at else self._learn(c) for c in chunks), np.int32, len(chunks))

    def _learn(self, chunk: str) -> int:
        self.pool.extend(self.encode_chunk(chunk))
        self.starts.append(len(self.pool))
        if len(chunk) <= MAX_CACHED_LENGTH:
            self.chunk_at[chunk] = len(self.starts) - 2
        return len(self.starts) - 2

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]. Null as empty."""
        if len(self.starts) > MAX_CHUNKS or len(self.pool) > 8 * MAX_CHUNKS:
            self.clear()
        none = np.zeros(0, np.int32)
        places = [self._places(t) if t else none for t in texts]
        sizes = np.cumsum([0, *map(len, places)])
        p = np.concatenate([none, *places])
        starts = np.array(self.starts, np.int64)
        length = starts[p + 1] - starts[p]
        ends = np.concatenate([[0], np.cumsum(length)])
        take = np.repeat(starts[p] - ends[:-1], length) + np.arange(ends[-1])
        return ends[sizes], np.array(self.pool, np.int32)[take] if len(take) else np.zeros(0, np.int32)

    def count_batch(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        return np.diff(self.encode_batch(texts)[0])

    def decode_batch(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts of ids, by the table of each token's place in one run of bytes."""
        size = self.ends[ids + 1] - self.ends[ids]
        to = np.concatenate([[0], np.cumsum(size)])
        raw = self.bytes[np.repeat(self.ends[ids] - to[:-1], size) + np.arange(to[-1])].tobytes()
        cut = to[offsets]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]


@lru_cache(maxsize=4)
def encoder(tokens: tuple[bytes, ...]) -> ByteBpe:
    return ByteBpe(list(tokens))
