"""Class-based bigram language model: exchange clustering of words, smoothed transitions and emissions.

Words outside the EXCHANGED most frequent ones share a class with all words of the same hashed
ending, so every word, seen or not, has a class. Counts of single words are exact for the whole
vocabulary: the most frequent ones (at most HEAD) travel with the tasks, the rest is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import small_batches, text_slices, written
from playledger.llm.words import LOWER, mix, span_hashes, spans

EXCHANGED = 4096
ENDINGS = 1024
CLASSES = 64
HEAD = 1 << 19
MOVES = 12
SMOOTH = 5.0
BLOCK = 512
FAN_IN = 64
UNITS = EXCHANGED + ENDINGS


@dataclass(frozen=True)
class Vocabulary:
    """Training counts: all words as a table (hash, ending, n), the frequent ones as arrays."""

    table: DataFrame
    head: np.ndarray
    head_counts: np.ndarray
    least: int
    n_tokens: int
    n_types: int
    n_texts: int
    type_counts: np.ndarray


class Lookup:
    """Index of 64-bit keys in an array, by open addressing; -1 for an unknown key."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, int(len(keys) * 4 - 1).bit_length())
        self.keys, self.mask = keys, np.uint64(size - 1)
        self.slots, self.reach = np.full(size, -1, np.int32), 0
        todo = np.arange(len(keys), dtype=np.int32)
        while len(todo):
            slot = ((keys[todo] + np.uint64(self.reach)) & self.mask).astype(np.int64)
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            todo = todo[self.slots[slot] != todo]
            self.reach += 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        todo = np.arange(len(keys))
        for probe in range(self.reach):
            at = self.slots[((keys[todo] + np.uint64(probe)) & self.mask).astype(np.int64)]
            hit = (at >= 0) & (self.keys[at] == keys[todo])
            out[todo[hit]] = at[hit]
            todo = todo[~hit & (at >= 0)]
            if not len(todo):
                break
        return out


def read_words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, ending and text index of every word, A-Z in lower case."""
    low = LOWER[data] if len(data) else data
    starts, lengths, owner = spans(data, edges)
    last = starts + lengths - 1
    ending = np.zeros(len(starts), np.uint64)
    for back in range(3):
        byte = np.where(lengths > back, low[np.maximum(last - back, 0)], 0) if len(starts) else ending
        ending = (ending << np.uint64(8)) | byte.astype(np.uint64)
    return span_hashes(low, starts, lengths), (mix(ending) % np.uint64(ENDINGS)).astype(np.int64), owner


def learn_vocabulary(docs: DataFrame, train: Column) -> Vocabulary:
    """Exact counts of the words of all rows of `docs(text)` that `train` selects.

    A task counts its own words first, so a frequent word leaves it once. The driver gets sums,
    one row per power of two of the counts, and the head: at most HEAD words, by a threshold.
    """

    def counted(batches):
        keys, endings, counts, held, texts = [], [], [], 0, 0

        def merged():
            found, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            total = np.bincount(back, np.concatenate(counts)).astype(np.int64)
            return found, np.concatenate(endings)[first], total

        for rows, data, edges in text_slices(batches, "text"):
            hashes, ending, _ = read_words(data, edges)
            found, first, n = np.unique(hashes, return_index=True, return_counts=True)
            keys.append(found), endings.append(ending[first]), counts.append(n)
            held, texts = held + len(found), texts + rows.num_rows
            if held > 1 << 21:
                keys, endings, counts = ([x] for x in merged())
                held = len(keys[0])
                if held > 1 << 20:
                    yield _counts(keys[0], endings[0], counts[0])
                    keys, endings, counts, held = [], [], [], 0
        if held:
            yield _counts(*merged())
        yield _counts(np.zeros(1, np.uint64), np.array([-1]), np.array([texts]))

    rows = docs.filter(train).select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counts = rows.mapInArrow(counted, "hash long, ending int, n long").groupBy("hash", "ending").agg(F.sum("n").alias("n"))
    everything = written(counts)
    table = everything.filter("ending >= 0")
    n_texts = everything.filter("ending < 0").agg(F.sum("n")).first()[0] or 0
    sizes = table.groupBy(F.floor(F.log2(F.col("n"))).alias("power")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n"))
    sizes = sorted((r["power"], r["types"], r["n"]) for r in sizes.collect())
    least, room = 1 << 62, HEAD
    for power, types, _ in reversed(sizes):
        if types > room:
            break
        least, room = 1 << power, room - types
    head = table.filter(F.col("n") >= least).select("hash", "n").toPandas()
    keys, n = head["hash"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64)
    order = np.lexsort((keys, -n))
    keys, n = keys[order], n[order]
    # types per unit: an exchanged word is alone in its unit
    alone = set(keys[:EXCHANGED].view(np.int64).tolist())
    by_ending = np.zeros(ENDINGS, np.int64)
    for row in table.groupBy("ending").count().collect():
        by_ending[row["ending"]] = row["count"]
    for row in table.filter(F.col("n") >= int(n[min(EXCHANGED, len(n)) - 1]) if len(n) else F.lit(False)).select("hash", "ending").collect():
        by_ending[row["ending"]] -= row["hash"] in alone
    types = np.zeros(UNITS, np.int64)
    types[: len(alone)] = 1
    types[EXCHANGED:] = by_ending
    n_words, n_types = sum(s[2] for s in sizes), sum(s[1] for s in sizes)
    return Vocabulary(table, keys, n, least, n_words + n_texts, n_types + (n_texts > 0), n_texts, types)


def _counts(keys: np.ndarray, endings: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(keys.view(np.int64)), pa.array(endings.astype(np.int32)), pa.array(counts.astype(np.int64))]
    return pa.record_batch(columns, ["hash", "ending", "n"])


def unit_of(hashes: np.ndarray, endings: np.ndarray, top: Lookup) -> np.ndarray:
    found = top.find(hashes).astype(np.int64)
    return np.where(found >= 0, found, EXCHANGED + endings)


def contexts(docs: DataFrame, train: Column, top: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts over all training rows: left class by unit, right class by unit, left class of an end.

    Class CLASSES stands for a text's edge. Each task sums dense blocks of BLOCK units; the
    blocks are added up by a tree of FAN_IN, so no task and not the driver sees all partial sums.
    """
    width = CLASSES + 1

    def counted(batches):
        left, right = np.zeros((UNITS + 1) * width, np.int64), np.zeros((UNITS + 1) * width, np.int64)
        lookup = Lookup(top)
        known = np.append(classes, CLASSES)
        for _, data, edges in text_slices(batches, "text"):
            hashes, endings, owner = read_words(data, edges)
            per_text = np.bincount(owner, minlength=len(edges) - 1)
            # an end after each text: unit UNITS, class CLASSES
            units = np.insert(unit_of(hashes, endings, lookup), np.cumsum(per_text), UNITS)
            kinds = known[units]
            before = np.concatenate(([CLASSES], kinds[:-1]))
            after = np.concatenate((kinds[1:], [CLASSES]))
            left += np.bincount(units * width + before, minlength=len(left))
            right += np.bincount(units * width + after, minlength=len(right))
        both = np.concatenate((left, right))
        part = TaskContext.get().partitionId()
        for block in range(0, len(both), BLOCK * width):
            values = both[block : block + BLOCK * width]
            yield _block(block // (BLOCK * width), part, values)

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("sums").to_pylist())
        row = _block(table.column("block")[0].as_py(), table.column("part")[0].as_py() // FAN_IN, total)
        return pa.Table.from_batches([row])

    schema = "block int, part int, sums binary"
    rows = docs.filter(train).select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sums = written(rows.mapInArrow(counted, schema))
    parts = (sums.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        sums = sums.groupBy("block", F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(added, schema)
        parts = -(-parts // FAN_IN)
    blocks = sorted((r["block"], r["part"], bytes(r["sums"])) for r in sums.collect())
    flat = np.zeros(2 * (UNITS + 1) * width, np.int64)
    for block, _, values in blocks:
        values = np.frombuffer(values, np.int64)
        at = block * BLOCK * width
        flat[at : at + len(values)] += values
    left, right = flat.reshape(2, UNITS + 1, width)
    return left[:UNITS], right[:UNITS], left[UNITS]


def _block(block: int, part: int, values: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([values.tobytes()], pa.binary())]
    return pa.record_batch(columns, ["block", "part", "sums"])


def exchange(left: np.ndarray, right: np.ndarray, classes: np.ndarray, moves: int = MOVES) -> np.ndarray:
    """Moves each unit to the class under which its neighbours are likeliest, all units per round.

    A class is described by how often each class stands before and after its words. The mutual
    information of neighbouring classes, which the exchange raises, has one such term for each side.
    """
    profile = np.concatenate((left, right), axis=1).astype(float)
    for _ in range(moves):
        sums = np.zeros((CLASSES, profile.shape[1]))
        np.add.at(sums, classes, profile)
        rate = np.log(sums + 0.1) - np.log(sums.reshape(CLASSES, 2, -1).sum(2).repeat(left.shape[1], axis=1) + 0.1 * left.shape[1])
        new = (profile @ rate.T).argmax(1)
        if (new == classes).all():
            break
        classes = new
    return classes


@dataclass(frozen=True)
class Model:
    """Classes of units and log10 tables of the class bigram model."""

    classes: np.ndarray
    transition: np.ndarray
    emission_total: np.ndarray


def fit_model(docs: DataFrame, train: Column, vocabulary: Vocabulary) -> Model:
    """Exchange clustering on two sweeps of the whole training text, transitions from a third."""
    top = vocabulary.head[:EXCHANGED]
    classes = np.arange(UNITS) % CLASSES
    for _ in range(2):
        left, right, _ends = contexts(docs, train, top, classes)
        classes = exchange(left, right, classes)
    left, right, ends = contexts(docs, train, top, classes)
    bigrams = np.zeros((CLASSES + 1, CLASSES + 1))
    by_class = np.zeros((CLASSES, CLASSES + 1))
    np.add.at(by_class, classes, left.astype(float))
    bigrams[:, :CLASSES] = by_class.T
    bigrams[:, CLASSES] = ends
    share = (bigrams.sum(0) + 0.5) / (bigrams.sum() + 0.5 * (CLASSES + 1))
    transition = (bigrams + SMOOTH * share) / (bigrams.sum(1, keepdims=True) + SMOOTH)
    types = np.bincount(classes, vocabulary.type_counts, CLASSES)
    return Model(classes, np.log10(transition), np.log10(bigrams[:, :CLASSES].sum(0) + 0.5 * (types + 1)))


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learns from all rows of `docs(doc_id, text)` but the held-out ones, and scores every row.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity. A
    text's tokens are its words and one end. A null or empty text is an end alone. A row whose
    `held_out` is null is learned from. Repeated rows are each learned from and scored; nothing learned leaves
    all counts 0. Words outside the head are joined with the rest of the vocabulary per text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = F.coalesce(held_out, F.lit(False))
    vocabulary = learn_vocabulary(docs, ~held)
    model = fit_model(docs, ~held, vocabulary)
    head, head_counts = vocabulary.head, vocabulary.head_counts
    n_texts, n_tokens, n_types = vocabulary.n_texts, vocabulary.n_tokens, vocabulary.n_types
    base_total = float(np.log10(n_tokens + 0.5 * (n_types + 1)))
    shared = spark.sparkContext.broadcast((head, head_counts, model.classes, model.transition, model.emission_total))

    def scored(batches):
        keys, counts, classes, transition, emission_total = shared.value
        words, top = Lookup(keys), Lookup(keys[:EXCHANGED])
        logs = np.log10(counts + 0.5)
        next_row = TaskContext.get().partitionId() << 40
        for rows, data, edges in text_slices(batches, "text"):
            n = rows.num_rows
            hashes, endings, owner = read_words(data, edges)
            at = words.find(hashes)
            known = at >= 0
            weight = np.where(known, logs[np.maximum(at, 0)], np.log10(0.5)) if len(logs) else np.full(len(at), np.log10(0.5))
            kinds = classes[unit_of(hashes, endings, top)]
            length = np.bincount(owner, minlength=n)
            ends = np.cumsum(length)
            chain = np.insert(kinds, ends, CLASSES)
            step = transition[np.concatenate(([CLASSES], chain[:-1])), chain]
            in_text = np.repeat(np.arange(n), length + 1)
            base = np.bincount(owner, weight - base_total, n) + np.log10(n_texts + 0.5) - base_total
            score = np.bincount(owner, weight - emission_total[kinds], n) + np.bincount(in_text, step, n)
            n_known = np.bincount(owner, known, n).astype(np.int64) + (n_texts > 0)
            rare_of, rare = owner[~known], hashes[~known]
            cuts = np.append(np.searchsorted(rare_of, np.arange(n)), len(rare_of)).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(cuts), pa.array(rare.view(np.int64)))
            columns = [
                pa.array(np.arange(next_row, next_row + n)), rows.column(0), rows.column(2),
                pa.array(length.astype(np.int64) + 1), pa.array(n_known), pa.array(base), pa.array(score), rest,
            ]
            next_row += n
            yield pa.record_batch(columns, ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
        "rare array<bigint>"
    )
    partial = written(docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(scored, schema))
    shared.unpersist()
    rare = partial.select("row", F.explode("rare").alias("hash")).groupBy("row", "hash").agg(F.count(F.lit(1)).alias("times"))
    tail = vocabulary.table.filter(F.col("n") < F.lit(vocabulary.least)).select("hash", "n")
    more = (
        rare.join(tail, "hash")
        .groupBy(F.col("row").alias("of_row"))
        .agg(F.sum("times").alias("found"), F.sum(F.col("times") * F.log10(F.col("n") * 2 + 1)).alias("gain"))
    )
    gain, found = F.coalesce(F.col("gain"), F.lit(0.0)), F.coalesce(F.col("found"), F.lit(0))
    return partial.join(more, F.col("row") == F.col("of_row"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + found).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + gain).alias("base_score"),
        (F.col("score") + gain).alias("score"),
        F.pow(F.lit(10.0), -(F.col("score") + gain) / F.col("n_tokens")).alias("perplexity"),
    )
