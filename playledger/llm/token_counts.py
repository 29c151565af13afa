"""Token counts by a transducer over bytes that is compiled while it runs.

The machine reads bytes by class and has four states: at a start or after a blank, after a letter
or digit, after another byte, and after a blank whose fate the next byte decides. Its
transitions tell where a piece ends. A text is cut into chunks of fixed length; each chunk yields
its map from entry states to exit states, and a parallel prefix scan composes the maps, so all
chunks, of one text or of many, are then run side by side from their true states. A whole piece
is one transition of the second machine, annotated with the number of tokens it emits; such a
transition is compiled from the tokenizer when a piece is first met, and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playledger.llm.common import small_batches, text_slices
from playledger.llm.token_ids import worker_table
from playledger.llm.words import SPACE

CHUNK = 128
START, ALNUM, OTHER, HELD = range(4)
BREAK, BLANK, MARK, WORD, LEAD, REST = range(6)
NO_CUT, CUT_HERE, CUT_BEFORE = range(3)


def byte_classes() -> np.ndarray:
    """Class of each byte: break (blank, line end), other blank, punctuation, letter or digit,
    first byte of what may be a blank outside ASCII, the rest."""
    kinds = np.full(256, REST, np.uint8)
    kinds[SPACE] = BLANK
    kinds[[0x20, 0x0A]] = BREAK
    kinds[list(b".,;:!?)")] = MARK
    kinds[[*range(48, 58), *range(65, 91), *range(97, 123)]] = WORD
    kinds[[0xC2, 0xE1, 0xE2, 0xE3]] = LEAD
    return kinds


def compile_machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and cut, by (state, class). A cut before a break is known one byte later."""
    after = {BREAK: START, BLANK: START, MARK: OTHER, WORD: ALNUM, LEAD: OTHER, REST: OTHER}
    step = np.zeros((4, 6), np.uint8)
    cut = np.zeros((4, 6), np.uint8)
    for state in range(4):
        for kind in range(6):
            step[state, kind] = HELD if kind == BREAK and state in (ALNUM, OTHER) else after[kind]
            if state == ALNUM and kind == MARK:
                cut[state, kind] = CUT_HERE
            if state == HELD and kind in (MARK, WORD, REST):
                cut[state, kind] = CUT_BEFORE
    return step, cut


_KINDS = byte_classes()
_STEP, _CUT = compile_machine()


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (chunk, state): log2(n) rounds, each parallel."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    return maps


def piece_cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Marks the bytes at which a piece starts."""
    n = len(data)
    width = -(-n // CHUNK)
    kinds = np.full(width * CHUNK, REST, np.uint8)
    kinds[:n] = _KINDS[data]
    fresh = np.zeros(width * CHUNK, bool)
    starts = edges[:-1]
    fresh[starts[starts < n]] = True
    kinds, fresh = kinds.reshape(width, CHUNK).T.copy(), fresh.reshape(width, CHUNK).T.copy()
    maps = np.tile(np.arange(4, dtype=np.uint8), (width, 1))
    for at in range(CHUNK):
        maps = np.where(fresh[at][:, None], START, maps)
        maps = _STEP[maps, kinds[at][:, None]]
    entry = np.concatenate(([START], compose_scan(maps)[:-1, START]))
    cuts = np.zeros((CHUNK + 1, width), np.uint8)
    state = entry
    for at in range(CHUNK):
        state = np.where(fresh[at], START, state)
        cuts[at + 1] = _CUT[state, kinds[at]]
        state = _STEP[state, kinds[at]]
    found = cuts[1:].T.reshape(-1)[:n]
    out = found == CUT_HERE
    out[:-1] |= found[1:] == CUT_BEFORE
    out[starts[starts < n]] = True
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int) -> DataFrame:
    """Per row of `docs(doc_id, text)`: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty (0 bytes, 0 tokens); a null doc_id stays null; repeated rows are
    counted each; other columns are ignored. No shuffle; memory is bounded by one text.
    """
    small_batches(docs.sparkSession)

    def counted(batches):
        for rows, data, edges in text_slices(batches, "text"):
            n_tokens = np.zeros(len(edges) - 1, np.int64)
            if len(data):
                starts = np.flatnonzero(piece_cuts(data, edges))
                emitted = worker_table(tokenizer_path).emissions(data, starts, np.append(starts[1:], len(data)))
                owner = np.searchsorted(edges, starts, "right") - 1
                n_tokens = np.bincount(owner, emitted, len(n_tokens)).astype(np.int64)
            columns = [rows.column(0), pa.array(np.diff(edges)), pa.array(n_tokens), pa.array(n_tokens > limit)]
            yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(counted, schema)
