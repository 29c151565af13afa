"""Best-fit packing by patterns of lengths: non-negative least squares on the length histogram."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm.common import small_batches, text_slices, written
from playledger.llm.token_ids import encode_texts

UNITS = 128
DEEPEST = 3
SALT_ROWS = 4096


def patterns(capacity: int, sizes: list[int], deepest: int = DEEPEST) -> list[tuple[int, ...]]:
    """All ways to fill `capacity` units exactly with one to `deepest` of `sizes`, largest first."""
    have, out = set(sizes), []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(chosen)
            return
        if len(chosen) == deepest:
            return
        top = min(left, chosen[-1] if chosen else capacity)
        slots = deepest - len(chosen)
        for size in range(top, -(-left // slots) - 1, -1):
            if size in have:
                extend((*chosen, size), left - size)

    extend((), capacity)
    return out


def least_squares(matrix: np.ndarray, wanted: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x with small |matrix x - wanted|: accelerated projected gradient."""
    if not matrix.size:
        return np.zeros(matrix.shape[1])
    gram, aim = matrix @ matrix.T, wanted.astype(float)
    rate = 1.0 / max(np.linalg.eigvalsh(gram)[-1], 1e-12)
    x = y = np.zeros(matrix.shape[1])
    pace = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - rate * (matrix.T @ (matrix @ y - aim)))
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        x, y, pace = new, new + (pace - 1) / faster * (new - x), faster
    return x


def plan_runs(histogram: dict[int, int], capacity: int, units: int = UNITS) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths) of sequences that hold every piece of `histogram` (length: count) once.

    Lengths are rounded up to `units`-th parts of a sequence; patterns of few pieces that fill a
    sequence are fitted to the histogram, their counts rounded down to what is there, and filled with exact
    lengths. Residual pieces go, longest first, where they fit best, in new sequences if
    nowhere. Works on runs of equal sequences, so its cost depends on the number of different
    lengths (at most `capacity`), not of pieces.
    """
    unit = max(1, -(-capacity // units))
    whole = capacity // unit
    left = {length: n for length, n in histogram.items() if n > 0}
    bins: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left):
        size = -(-length // unit)
        if size <= whole:
            bins[size].append(length)
    open_runs: list[tuple[int, tuple[int, ...]]] = []
    sizes = sorted(bins)
    shapes = patterns(whole, sizes)
    if shapes:
        row = {size: k for k, size in enumerate(sizes)}
        matrix = np.zeros((len(sizes), len(shapes)))
        for k, shape in enumerate(shapes):
            for size in shape:
                matrix[row[size], k] += 1
        there = np.array([sum(left[length] for length in bins[size]) for size in sizes], float)
        fitted = least_squares(matrix, there)
        # shapes with the largest counts first; what is left over after rounding is refitted once
        for times in (fitted, None):
            if times is None:
                times = least_squares(matrix, there)
            for k in np.argsort(-times, kind="stable").tolist():
                need = matrix[:, k]
                most = int(np.min(there[need > 0] // need[need > 0]))
                repeat = min(int(times[k] + 1e-6), most)
                if repeat <= 0:
                    continue
                there -= need * repeat
                open_runs += _fill(shapes[k], repeat, bins, left)
    return _place_rest(open_runs, left, capacity)


def _fill(shape, repeat: int, bins, left) -> list[tuple[int, tuple[int, ...]]]:
    """Runs of sequences of one shape with exact lengths, the longest of each size first."""
    runs = []
    while repeat > 0:
        use: dict[int, int] = defaultdict(int)
        lengths = []
        for size in shape:
            length = next(x for x in reversed(bins[size]) if left[x] > use[x])
            use[length] += 1
            lengths.append(length)
        times = min([repeat, *(left[x] // n for x, n in use.items())])
        for length, n in use.items():
            left[length] -= n * times
        for size in set(shape):
            while bins[size] and left[bins[size][-1]] == 0:
                bins[size].pop()
        runs.append((times, tuple(lengths)))
        repeat -= times
    return runs


def _place_rest(runs, left: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit of the residual lengths, longest first, into the room of the runs."""
    rooms: dict[int, list] = defaultdict(list)
    order: list[int] = []
    full: list[tuple[int, tuple[int, ...]]] = []

    def put(times: int, lengths: tuple[int, ...]) -> None:
        room = capacity - sum(lengths)
        if room == 0:
            full.append((times, lengths))
            return
        if room not in rooms or not rooms[room]:
            insort(order, room)
        rooms[room].append((times, lengths))

    for run in runs:
        put(*run)
    for length in sorted((x for x, n in left.items() if n > 0), reverse=True):
        n = left[length]
        while n > 0:
            at = bisect_left(order, length)
            if at == len(order):
                per = capacity // length
                times, rest = divmod(n, per)
                if times:
                    put(times, (length,) * per)
                if rest:
                    put(1, (length,) * rest)
                break
            room = order[at]
            times, lengths = rooms[room].pop()
            if not rooms[room]:
                order.pop(at)
            used = min(times, n)
            if used < times:
                put(times - used, lengths)
            put(used, (*lengths, length))
            n -= used
    return full + [run for room in order for run in rooms[room]]


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, row_key, piece, start, length, ids_crc32: every document's ids, cut only above `capacity`.

    A null or empty text has the end id alone. Repeated rows give their pieces each time.
    """
    small_batches(docs.sparkSession)
    fields = [
        pa.field("doc_id", pa.int64()), pa.field("row_key", pa.int64()), pa.field("piece", pa.int32()),
        pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64()),
    ]

    def cut(batches):
        for rows, data, edges in text_slices(batches, "text"):
            count, ids = encode_texts(data, edges, tokenizer_path)
            ids = np.insert(ids.astype("<u4"), np.cumsum(count), end_id)
            count = count + 1
            pieces = -(-count // capacity)
            row = np.repeat(np.arange(len(count)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, count[row] - start)
            at = (np.cumsum(count) - count)[row] + start
            sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
            owners, keys = rows.column(0).take(pa.array(row)), rows.column(1).take(pa.array(row))
            values = [owners, keys, piece.astype(np.int32), start, length, np.array(sums, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in values], schema=pa.schema(fields))

    schema = "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long"
    keyed = docs.select("doc_id", F.xxhash64("doc_id", F.length("text")).alias("row_key"), "text")
    return keyed.mapInArrow(cut, schema)


def ranks(pieces: DataFrame) -> DataFrame:
    """Adds `rank`: a number from 0 among the pieces of equal length.

    A length that a third of all pieces share is ranked in salted parts, each offset by the
    number of pieces in the parts before it.
    """
    counts = written(pieces.withColumn("salt", _salt(pieces)).groupBy("length", "salt").count())
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("length").alias("__length"), F.col("salt").alias("__salt"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "salt").orderBy("row_key", "doc_id", "piece", "ids_crc32")
    salted = pieces.withColumn("salt", _salt(pieces)).withColumn("within", F.row_number().over(within) - 1)
    joined = salted.join(offsets, (F.col("length") == F.col("__length")) & (F.col("salt") == F.col("__salt")))
    return joined.withColumn("rank", F.col("within") + F.col("before")).drop("salt", "within", "before", "__length", "__salt")


def _salt(pieces: DataFrame):
    n = pieces.count()
    return F.pmod(F.xxhash64("row_key", "piece"), F.lit(max(1, n // SALT_ROWS)))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Places every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The histogram of lengths (at most `capacity` rows) is planned on the driver as runs of equal
    sequences. A run and a place in it own a range of ranks of its length; a piece finds its
    range by binary search in that plan, which has at most a few rows per length and pattern. Null doc_ids are packed like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, tokenizer_path, end_id, capacity))
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    runs = plan_runs(histogram, capacity)
    taken: dict[int, int] = defaultdict(int)
    places, sequence = [], 0
    for times, lengths in runs:
        offset = 0
        for length in lengths:
            places.append((length, taken[length], taken[length] + times, sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    columns = ["__length", "first", "past", "first_sequence", "offset"]
    frame = pd.DataFrame(places, columns=columns).astype("int64")

    def settle(batches):
        lengths, firsts = frame["__length"].to_numpy(), frame["first"].to_numpy()
        sequences, offsets = frame["first_sequence"].to_numpy(), frame["offset"].to_numpy()
        order = np.lexsort((firsts, lengths))
        # length and rank in one ascending key: places are found by binary search
        span = np.int64(1) << 48
        keys = lengths[order] * span + firsts[order]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = order[np.searchsorted(keys, length * span + rank, "right") - 1] if len(keys) else np.zeros(0, np.int64)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kept = [batch.column(name) for name in names]
            found = [pa.array(sequences[at] + rank - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays([*kept, *found], [*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    return ranks(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(settle, schema)
