"""Static range asymmetric numeral system over token ids, many lanes at a time.

One frequency table serves all data. A packet holds the ids of some whole documents as
independent blocks of up to 65,536 ids; a block interleaves 64 coder states. Before every 256th
step a block keeps a checkpoint (its 64 states and its place in the stream), from which decoding
can start, and it has a CRC-32 of its ids. Layout, little-endian: magic, ids (u64), blocks,
steps and segments (u32); stream words per segment (u32); CRC per block (u32); states (u64);
stream words (u32).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RANS20-1"
BITS = 20
LANES = 64
STEPS = 1024
SEGMENT = 256
_HEAD = "<8sQIII"
_LOW = np.uint64(1 << 31)


class Table:
    """Symbol frequencies scaled to 2**20; every symbol that occurs keeps at least 1."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray):
        order = np.argsort(symbols)
        symbols, counts = symbols[order].astype(np.int64), counts[order].astype(np.int64)
        total = 1 << BITS
        scaled = np.maximum(1, (counts / max(counts.sum(), 1) * total).astype(np.int64))
        excess = int(scaled.sum()) - total
        while excess > 0:
            most = int(np.argmax(scaled))
            less = min(excess, max(1, int(scaled[most]) // 2))
            scaled[most] -= less
            excess -= less
        if len(scaled):
            scaled[int(np.argmax(scaled))] -= excess
        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.freq = np.zeros(size, np.uint64)
        self.start = np.zeros(size, np.uint64)
        self.freq[symbols] = scaled
        self.start[symbols] = np.cumsum(scaled) - scaled
        self.slot = np.repeat(symbols, scaled).astype(np.uint32)
        self.filler = int(symbols[np.argmax(scaled)]) if len(symbols) else 0


def encode(ids: np.ndarray, table: Table) -> bytes:
    """A packet of `ids`; every id must occur in the table."""
    n = len(ids)
    steps = min(STEPS, -(-n // LANES)) if n else 0
    blocks = -(-n // (LANES * steps)) if n else 0
    segments = -(-steps // SEGMENT)
    head = struct.pack(_HEAD, MAGIC, n, blocks, steps, segments)
    if not n:
        return head
    padded = np.full(blocks * steps * LANES, table.filler, np.int64)
    padded[:n] = ids
    grid = padded.reshape(blocks, steps, LANES)
    freq, start = table.freq, table.start
    state = np.full((blocks, LANES), _LOW, np.uint64)
    words = np.zeros((blocks, steps, LANES), np.uint32)
    sent = np.zeros((blocks, steps, LANES), bool)
    states = np.zeros((blocks, segments, LANES), np.uint64)
    for step in range(steps - 1, -1, -1):
        symbol = grid[:, step]
        f = freq[symbol]
        full = state >= f << np.uint64(63 - BITS)
        sent[:, step] = full
        words[:, step] = state & np.uint64(0xFFFFFFFF)
        state = np.where(full, state >> np.uint64(32), state)
        whole = state // f
        state = (whole << np.uint64(BITS)) + (state - whole * f) + start[symbol]
        if step % SEGMENT == 0:
            states[:, step // SEGMENT] = state
    lengths = np.add.reduceat(sent.sum(2, dtype=np.uint32), np.arange(0, steps, SEGMENT), axis=1)
    sums = [zlib.crc32(ids[b * steps * LANES : (b + 1) * steps * LANES].astype("<u4")) for b in range(blocks)]
    parts = (lengths.astype("<u4"), np.array(sums, "<u4"), states.astype("<u8"), words[sent].astype("<u4"))
    return head + b"".join(p.tobytes() for p in parts)


def _unpack(packet: bytes):
    magic, n, blocks, steps, segments = struct.unpack_from(_HEAD, packet)
    if magic != MAGIC:
        raise ValueError("not a packet of token ids")
    at = struct.calcsize(_HEAD)

    def take(kind: str, *shape: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(packet, kind, int(np.prod(shape)), at).reshape(shape)
        at += out.nbytes
        return out

    lengths = take("<u4", blocks, segments)
    sums = take("<u4", blocks)
    states = take("<u8", blocks, segments, LANES)
    words = np.frombuffer(packet, "<u4", offset=at)
    if len(words) != int(lengths.sum()):
        raise ValueError("the stream of a packet is cut short")
    return n, blocks, steps, segments, lengths, sums, states, words


def decode_segment(packet: bytes, table: Table, block: int, segment: int) -> np.ndarray:
    """The ids of one segment alone, from its checkpoint."""
    n, blocks, steps, segments, lengths, _, states, words = _unpack(packet)
    flat = block * segments + segment
    place = int(lengths.reshape(-1)[:flat].sum())
    last = min(steps, (segment + 1) * SEGMENT) - segment * SEGMENT
    out = _run(states[block, segment][None], np.array([place]), words, table, last)
    first = (block * steps + segment * SEGMENT) * LANES
    return out.reshape(-1)[: max(0, min(n - first, out.size))]


def decode(packet: bytes, table: Table) -> np.ndarray:
    """All ids; every segment of every block runs side by side. A wrong checksum raises."""
    n, blocks, steps, segments, lengths, sums, states, words = _unpack(packet)
    if not n:
        return np.zeros(0, np.uint32)
    places = np.cumsum(lengths.reshape(-1).astype(np.int64)) - lengths.reshape(-1)
    grid = np.zeros((blocks, segments * SEGMENT, LANES), np.uint32)
    full = steps // SEGMENT
    places = places.reshape(blocks, segments)
    if full:
        out = _run(states[:, :full].reshape(-1, LANES), places[:, :full].reshape(-1), words, table, SEGMENT)
        grid[:, : full * SEGMENT] = out.reshape(blocks, full * SEGMENT, LANES)
    if full < segments:
        out = _run(states[:, full], places[:, full], words, table, steps - full * SEGMENT)
        grid[:, full * SEGMENT : steps] = out
    ids = grid[:, :steps].reshape(-1)[:n]
    for b in range(blocks):
        if zlib.crc32(ids[b * steps * LANES : (b + 1) * steps * LANES].astype("<u4")) != int(sums[b]):
            raise ValueError(f"block {b} of a packet fails its checksum")
    return ids


def _run(state: np.ndarray, place: np.ndarray, words: np.ndarray, table: Table, steps: int) -> np.ndarray:
    """Decodes `steps` steps of runs of lanes: (runs, steps, lanes) ids."""
    state, place = state.copy(), place.astype(np.int64)
    out = np.zeros((len(state), steps, LANES), np.uint32)
    padded = np.append(words, np.zeros(LANES, "<u4"))
    mask = np.uint64((1 << BITS) - 1)
    for step in range(steps):
        low = state & mask
        symbol = table.slot[low.astype(np.int64)]
        out[:, step] = symbol
        state = table.freq[symbol] * (state >> np.uint64(BITS)) + low - table.start[symbol]
        empty = state < _LOW
        ahead = np.cumsum(empty, axis=1)
        read = padded[np.minimum(place[:, None] + ahead - 1, len(padded) - 1)]
        state = np.where(empty, state << np.uint64(32) | read, state)
        place += ahead[:, -1]
    return out
