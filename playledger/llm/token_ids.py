"""Token ids of whole texts, as a tokenizers file gives them.

A text is cut where its tokens cannot depend on what stands across: before a single blank or
line end between two other characters, and before a punctuation mark after a letter or digit.
Each distinct piece is encoded by the library once per worker and kept in a table of fixed size.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np

from playledger.llm.words import SPACE, span_hashes

SLOTS = 1 << 21
POOL = 1 << 23
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:!?)")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x0A]] = True
_OPEN = SPACE.copy()
_OPEN[[0xC2, 0xE1, 0xE2, 0xE3]] = True
"""Blanks, and the first bytes of blanks outside ASCII."""


def piece_starts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pieces start: every text's start and every safe cut inside."""
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 2:
        inner = data[1:-1]
        cut[1:-1] = _BREAK[inner] & ~SPACE[data[:-2]] & ~_OPEN[data[2:]]
    if n > 1:
        cut[1:] |= _PUNCTUATION[data[1:]] & _ALNUM[data[:-1]]
    # the last byte of a text sees no neighbour of its own: no cut before a blank there
    last = edges[1:] - 1
    last = last[last >= 0]
    cut[last] &= ~_BREAK[data[last]]
    starts = edges[:-1]
    cut[starts[starts < n]] = True
    return np.flatnonzero(cut)


class PieceTable:
    """Ids of pieces by hash: a direct-mapped table; a new piece replaces the one in its slot."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        special = [(x.content, i) for i, x in self.tokenizer.get_added_tokens_decoder().items()]
        self.mark = next(((c, i) for c, i in special if not any(c in d for d, _ in special if d != c)), (None, 0))
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.place = np.zeros(SLOTS, np.int32)
        self.count = np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(POOL, self.width)
        self.used = 0

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids per piece (count) and all ids in order."""
        return self._gather(*self._find(data, starts, ends))

    def emissions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of ids per piece."""
        return self._find(data, starts, ends)[2]

    def _find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pool, and each piece's place and count in it."""
        hashes = span_hashes(data, starts, ends - starts)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        known = self.keys[slot] == hashes
        place, count = self.place[slot].astype(np.int64), self.count[slot].astype(np.int64)
        pool = self.pool
        missing = np.flatnonzero(~known)
        if len(missing):
            _, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            at = missing[first]
            raw = data.tobytes()
            texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            sizes, ids = self.encode_new(texts)
            if self.used + len(ids) > POOL:
                # the table is full: what this batch still needs stays in the old pool
                kept = pool
                self.clear()
                if len(ids) > POOL:
                    base = len(kept)
                    pool = np.concatenate((kept, ids))
                    place[missing] = (base + np.cumsum(sizes) - sizes)[back]
                    count[missing] = sizes[back]
                    return pool, place, count
                pool = np.concatenate((kept, ids))
                places = len(kept) + np.cumsum(sizes) - sizes
                self._keep(hashes[at], ids, sizes)
            else:
                places = self._keep(hashes[at], ids, sizes)
            place[missing], count[missing] = places[back], sizes[back]
        return pool, place, count

    def encode_new(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces by the library, joined by a special token that it splits at before anything else."""
        mark, mark_id = self.mark
        if mark is None or any(mark in x for x in texts):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return sizes, np.fromiter((i for x in found for i in x), self.width, int(sizes.sum()))
        joined = self.tokenizer.encode_batch_fast([mark.join(texts) + mark], add_special_tokens=False)[0].ids
        ids = np.array(joined, np.int64)
        ends = np.flatnonzero(ids == mark_id)
        sizes = np.diff(ends, prepend=-1) - 1
        return sizes, np.delete(ids, ends).astype(self.width)

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        places = self.used + np.cumsum(sizes) - sizes
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        self.keys[slot] = hashes
        # of two new pieces with one slot the later stays, in all three columns alike
        self.place[slot] = places
        self.count[slot] = sizes
        return places

    @staticmethod
    def _gather(pool: np.ndarray, place: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before = np.cumsum(count) - count
        return count, pool[np.arange(int(count.sum())) + np.repeat(place - before, count)]


def worker_table(path: str) -> PieceTable:
    """One table per file and Python worker, kept from task to task."""
    home = sys.modules.setdefault("_piece_tables", types.ModuleType("_piece_tables"))
    tables = home.__dict__.setdefault("tables", {})
    if path not in tables:
        tables[path] = PieceTable(path)
    return tables[path]


def encode_texts(data: np.ndarray, edges: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids per text, and the ids of all texts in order."""
    n_texts = len(edges) - 1
    if not len(data):
        return np.zeros(n_texts, np.int64), np.zeros(0, np.uint16)
    starts = piece_starts(data, edges)
    count, ids = worker_table(path).encode(data, starts, np.append(starts[1:], len(data)))
    owner = np.searchsorted(edges, starts, "right") - 1
    return np.bincount(owner, count, n_texts).astype(np.int64), ids
