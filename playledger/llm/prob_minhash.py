"""Near-duplicate classes: ProbMinHash signatures, banding, exact verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from playledger.llm.common import Steps, small_batches, text_slices, written
from playledger.llm.words import mix, word_hashes

SHINGLE = 5
REGISTERS = 100
BANDS = 20
LEAST = 0.8
WHOLE_BUCKET = 16
FIRST_PIVOTS = 4
MORE_PIVOTS = 16
UNITED = 8
SALTED = 256
FOLDS = 64
HEADS = 64
PART_BUCKETS = 1024
MEASURES = ["inside", "met", "excess", "total"]
TASK_ROWS = 1 << 20
SEEN_BITS = 21
"""Slots, as a power of two, of the table of shingles met in several texts: two bits each, 512 KB."""
SEEN_GROUPS = 16
KEPT_BYTES = 64 << 20
_ROUNDING = 1e-12
Shingles = tuple[np.ndarray, np.ndarray, float]
"""Hashes in ascending order, their weights, and the sum of these."""
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with their weights: (hash, count, text), ordered by text and hash.

    A shingle is SHINGLE words in a row; a shorter text that has words is one shingle.
    """
    words, owner = word_hashes(data, edges)
    if not len(words):
        return words, np.zeros(0), owner
    per_text = np.bincount(owner, minlength=len(edges) - 1)
    value = np.zeros(len(words), np.uint64)
    same = np.ones(len(words), bool)
    for k in range(SHINGLE):
        later = np.minimum(np.arange(len(words)) + k, len(words) - 1)
        inside = (np.arange(len(words)) + k < len(words)) & (owner[later] == owner)
        value = mix(value * _GOLD + np.where(inside, words[later], np.uint64(0)))
        same &= inside
    first = np.concatenate(([True], owner[1:] != owner[:-1]))
    keep = same | (first & (per_text[owner] < SHINGLE))
    value, owner = value[keep], owner[keep]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    opens = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))))
    return value[opens], np.diff(np.append(opens, len(value))).astype(np.float64), owner[opens]


def signatures(value: np.ndarray, weight: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """ProbMinHash: (text, register) shingles; two texts agree in a register with probability J_P.

    Each shingle is a Poisson process of rate `weight` whose arrivals fall into random
    registers; a register keeps the shingle that arrived first. A shingle stops as soon as its
    next arrival is later than everything its text's registers hold.
    """
    first = np.full(n_texts * REGISTERS, np.inf)
    kept = np.zeros(n_texts * REGISTERS, np.uint64)
    latest = np.full(n_texts, np.inf)
    time = np.zeros(len(value))
    active = np.arange(len(value))
    draw = mix(value)
    turn = 0
    while len(active):
        turn += 1
        bits = mix(draw[active] + np.uint64(turn * int(_GOLD) % 2**64))
        time[active] -= np.log(((bits >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52) / weight[active]
        live = time[active] < latest[owner[active]]
        active, bits = active[live], bits[live]
        register = owner[active] * REGISTERS + (mix(bits + _GOLD) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(first, register, time[active])
        won = time[active] == first[register]
        kept[register[won]] = value[active[won]]
        texts = np.unique(owner[active])
        latest[texts] = first.reshape(n_texts, REGISTERS)[texts].max(1)
        active = active[time[active] < latest[owner[active]]]
    return kept.reshape(n_texts, REGISTERS)


def bands(kept: np.ndarray) -> np.ndarray:
    """A hash per text and band of neighbouring registers."""
    rows = kept.reshape(len(kept), BANDS, -1)
    value = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(kept), 1))
    for k in range(rows.shape[2]):
        value = mix(value * _GOLD + rows[:, :, k])
    return value


def _common(a: Shingles, b: Shingles) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the shingles that both sets have, in a and in b."""
    if not len(a[0]) or not len(b[0]):
        return np.zeros(0), np.zeros(0)
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    return a[1][both] / a[2], b[1][at[both]] / b[2]


def _agreement(x: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard from the shares of the common shingles; all other mass is on one side only."""
    if not len(x):
        return 0.0
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # for a common shingle: shares of a with no smaller ratio, and of b with a smaller one
    from_a = np.concatenate((np.cumsum(x[::-1])[::-1], [0.0])) + 1.0 - x.sum()
    from_b = np.concatenate(([0.0], np.cumsum(y))) + 1.0 - y.sum()
    at = np.searchsorted(ratio, ratio, "left")
    return float((1.0 / (from_a[at] / x + from_b[at] / y)).sum())


def similarity(a: Shingles, b: Shingles) -> float:
    """Probability Jaccard of two weighted sets."""
    return _agreement(*_common(a, b))


def alike(a: Shingles, b: Shingles, least: float) -> bool:
    """Whether the probability Jaccard is `least` or more.

    It is at most the sum of the smaller shares, which settles most pairs that are not alike.
    """
    x, y = _common(a, b)
    return float(np.minimum(x, y).sum()) >= least - _ROUNDING and _agreement(x, y) >= least - _ROUNDING


class ShingleSets:
    """Shingle sets by node, as a task meets them; all are forgotten once they fill KEPT_BYTES."""

    def __init__(self):
        self.known: dict[bytes, Shingles] = {}
        self.size = 0

    def of(self, nodes: list[bytes], data: np.ndarray, edges: np.ndarray) -> list[Shingles]:
        if self.size > KEPT_BYTES:
            self.__init__()
        fresh = {node: i for i, node in enumerate(nodes) if node not in self.known}
        if fresh:
            texts = [data[edges[i] : edges[i + 1]] for i in fresh.values()]
            value, weight, owner = shingles(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
            for node, p, q in zip(fresh, cuts[:-1].tolist(), cuts[1:].tolist()):
                # copies: a view would hold the whole slice
                self.known[node] = (value[p:q].copy(), weight[p:q].copy(), weight[p:q].sum())
            self.size += 16 * len(value) + 400 * len(texts)
        return [self.known[node] for node in nodes]


def text_keys(data: np.ndarray, edges: np.ndarray) -> list[bytes | None]:
    """128-bit key of each text's word sequence (A-Z in lower case); none for a text without words."""
    words, owner = word_hashes(data, edges)
    n = len(edges) - 1
    count = np.bincount(owner, minlength=n)
    place = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
    keys = np.zeros((n, 2), np.uint64)
    used = np.flatnonzero(count)
    if len(used):
        starts = (np.cumsum(count) - count)[used]
        for k in range(2):
            salted = mix(words ^ mix(place.astype(np.uint64) + np.uint64(k << 60)) * _GOLD)
            keys[used, k] = mix(np.add.reduceat(salted, starts) + count[used].astype(np.uint64))
    raw = keys.tobytes()
    return [raw[16 * i : 16 * i + 16] if count[i] else None for i in range(n)]


def _signed(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text, ...)` with node and bands; node is null for a text without words."""
    names = [*docs.columns, "node", "bands"]

    def sign(batches):
        for rows, data, edges in text_slices(batches, "text", 4 << 20):
            n = rows.num_rows
            keys = text_keys(data, edges)
            value, weight, owner = shingles(data, edges)
            found = bands(signatures(value, weight, owner, n)).view(np.int64)
            cuts = pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32))
            signature = pa.ListArray.from_arrays(cuts, pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys, pa.binary()), signature], names)

    schema = StructType([*docs.schema.fields]).add("node", "binary").add("bands", ArrayType(LongType()))
    return docs.mapInArrow(sign, schema)


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The labels of those `pairs(a, b, label_a, label_b)` whose texts have a probability Jaccard of `least` or more."""
    named = texts.select(F.col("node").alias("__node"), "text")
    both = (
        pairs.join(named.withColumnRenamed("text", "text_b"), F.col("b") == F.col("__node"))
        .drop("__node")
        .join(named.withColumnRenamed("text", "text_a"), F.col("a") == F.col("__node"))
        .select("a", "b", "label_a", "label_b", "text_a", "text_b")
    )

    def check(batches):
        sets = ShingleSets()
        for rows, data_a, edges_a in text_slices(batches, "text_a", 1 << 20):
            left, close = sets.of(rows.column("a").to_pylist(), data_a, edges_a), []
            for other, data_b, edges_b in text_slices(iter([rows]), "text_b", 1 << 20):
                right = sets.of(other.column("b").to_pylist(), data_b, edges_b)
                close += [alike(x, y, least) for x, y in zip(left[len(close) :], right)]
            yield rows.select(["label_a", "label_b"]).filter(pa.array(close, pa.bool_()))

    return both.mapInArrow(check, "label_a binary, label_b binary")


class Narrow(Steps):
    """Tables of links, labels and buckets: a step writes `rows` rows at most, in tasks of TASK_ROWS or one per core."""

    def __init__(self, spark, rows: int):
        super().__init__(spark)
        self.tasks = max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))

    def put(self, df: DataFrame) -> DataFrame:
        return super().put(df.coalesce(self.tasks))


def components(edges: DataFrame, rows: int = 0) -> DataFrame:
    """Smallest node of the component of every node of `edges(a, b)`: (node, label).

    Each round takes the smallest label among neighbours, then the label's own label, so paths halve;
    every round is written to the shared folder, and only whether labels changed reaches the driver. `rows` bounds the edges.
    """
    steps = Narrow(edges.sparkSession, 2 * rows)
    arcs = steps.put(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = steps.put(arcs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = arcs.join(of, "b").groupBy("a").agg(F.min("near").alias("near")).withColumnRenamed("a", "node")
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        lower = steps.put(lower)
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        raised = steps.put(lower.join(up, "label").select("node", F.least("label", "up").alias("label"), "old"))
        steps.drop(labels, lower)
        if raised.filter("label != old").isEmpty():
            steps.drop(arcs)
            return raised.select("node", "label")
        labels = steps.put(raised.select("node", "label"))
        steps.drop(raised)


def _outside(text: Shingles, union: tuple[np.ndarray, np.ndarray], least: float) -> tuple:
    """Of a text: share of its mass in the union, the union's and its own excess weight there, its
    whole weight, and its first shingles outside, up to the mass that a text alike may lack."""
    value, weight = union
    own, count, total = text
    at = np.minimum(np.searchsorted(value, own), len(value) - 1)
    both = value[at] == own
    share = count[~both] / total
    first = own[~both][np.cumsum(share) - share <= 1.0 - least + _ROUNDING]
    inside, there = count[both], weight[at[both]]
    return inside.sum() / total, there.sum(), np.maximum(0.0, inside - there).sum(), total, first.view(np.int64)


def outside_pivots(rows: DataFrame, least: float) -> DataFrame:
    """Compares members with the united shingles of their bucket's first pivots.

    `rows(bucket, salt, pivot, node, label, text)`: a large bucket is dealt over salts, and its few pivots
    are in each, sorted before the members.
    """

    def compare(batches):
        key, parts, union = None, [], None
        for batch, data, edges in text_slices(batches, "text", 1 << 20):
            value, weight, owner = shingles(data, edges)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            buckets, salts, leads = (batch.column(name).to_pylist() for name in ("bucket", "salt", "pivot"))
            kept, out = [], []
            for i, at in enumerate(zip(buckets, salts)):
                if at != key:
                    key, parts, union = at, [], None
                own = slice(cuts[i], cuts[i + 1])
                if leads[i]:
                    parts.append((value[own].copy(), weight[own].copy()))
                    continue
                if union is None:
                    union = _united(parts)
                kept.append(i)
                out.append(_outside((value[own], weight[own], weight[own].sum()), union, least))
            mine = batch.select(["bucket", "node", "label"]).take(pa.array(kept, pa.int64()))
            columns = [pa.array([r[c] for r in out], pa.float64()) for c in range(4)]
            first = pa.array([r[4] for r in out], pa.list_(pa.int64()))
            yield pa.record_batch([*mine.columns, *columns, first], ["bucket", "node", "label", "inside", "met", "excess", "total", "first"])

    schema = "bucket long, node binary, label binary, inside double, met double, excess double, total double, first array<bigint>"
    dealt = rows.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", F.col("pivot").desc())
    return dealt.select("bucket", "salt", "pivot", "node", "label", "text").mapInArrow(compare, schema)


def _united(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several sets, each with its largest weight."""
    value, weight = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((-weight, value))
    value, weight = value[order], weight[order]
    opens = np.concatenate(([True], value[1:] != value[:-1]))
    return value[opens], weight[opens]


def _reach(least_total, most_excess):
    """1/f + 1/g of a member with the most favourable other member that shares nothing outside the pivots."""
    other = F.least(F.lit(1.0), F.col("met") / least_total + most_excess)
    return 1.0 / F.greatest("inside", F.lit(1e-9)) + 1.0 / F.greatest(other, F.lit(1e-9))


def near_links(members: DataFrame, texts: DataFrame, least: float, rows: int = 0) -> list[DataFrame]:
    """Maps (old, new) of labels, to be applied in turn, that merge what verified pairs connect.

    `members(bucket, node, label)`, labels being the nodes. In every round the first few members of each
    bucket are its pivots (all, in a small bucket), every later member with another label is compared
    with them, and pivots then leave. What is left of a bucket with several labels is split by the
    shingles outside the pivots' union S. Two texts that are alike share one of these, and meet in
    the bucket of the least such shingle; or they share none, then both lie mostly in S. With f and g the
    shares of their masses that can be common, J_P <= 1 / (1/f + 1/g - 1), for which f is at most the
    share inside S, and at most what the other text has of S, as weight, over the own weight. Members
    that reach `least` with no other member of the bucket by this bound leave it; the rest stay, those
    nearest to S first, as these connect the most. So a pair that shares a bucket is compared, already connected
    or excluded by the bound: no link is lost, and a large group of copies costs a few pairs per member.
    """
    maps, turn, steps = [], 0, Narrow(members.sparkSession, rows)
    within = 1.0 + 1.0 / least + 1e-9
    chance = F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(1 << 40)) / float(1 << 40)
    unknown = [F.lit(None).cast("double").alias(name) for name in MEASURES]
    members = members.select("bucket", "node", "label", chance.alias("place"), *unknown)
    while True:
        few = FIRST_PIVOTS * MORE_PIVOTS ** max(0, turn - 1)
        ranked = Window.partitionBy("bucket").orderBy("place", "node")
        sizes = members.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("size"))
        leads = members.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= max(few, WHOLE_BUCKET))
        leads = leads.join(sizes, F.col("bucket") == F.col("of")).filter((F.col("rank") <= few) | (F.col("size") <= WHOLE_BUCKET))
        pivots = steps.put(leads.select("of", *(F.col(n).alias(f"{n}_a") for n in ["node", "label", "place", *MEASURES]), "rank", "size"))
        pairs = _first_pairs(members, pivots) if turn == 0 else _later_pairs(members, pivots, within)
        found = steps.put(verified(pairs, texts, least).distinct())
        last = pivots.groupBy("of").agg(F.max(F.struct("place_a", "node_a")).alias("last"), F.max("size").alias("size"))
        rest = members.join(last, F.col("bucket") == F.col("of")).filter(
            F.struct(F.col("place").alias("place_a"), F.col("node").alias("node_a")) > F.col("last")
        )
        if not found.isEmpty():
            maps.append(merged_labels(found, rows))
            rest = relabelled(rest, maps[-1:])
        rest = steps.put(several(rest.drop("of", "last")))
        steps.drop(members, found)
        if rest.isEmpty():
            return maps
        fresh = rest.filter("inside is null")
        split = folded = by_shingle = None
        stays = rest.filter("inside is not null").select("bucket", "node", "label", "place", *MEASURES)
        if not fresh.isEmpty():
            split = steps.put(outside_pivots(_with_pivots(fresh, pivots, texts), least))
            near = F.round(1.0 - F.col("inside"), 3) + chance / 1000.0
            stays = stays.unionByName(split.select("bucket", "node", "label", near.alias("place"), *MEASURES))
            folded = steps.put(folded_shingles(split))
            by_shingle = steps.put(outside_buckets(folded).select("bucket", "node", "label", chance.alias("place"), *unknown))
        ends = stays.groupBy(F.col("bucket").alias("of")).agg(
            F.min("total").alias("least_total"), F.max(F.col("excess") / F.col("total")).alias("most_excess")
        )
        reach = _reach(F.col("least_total"), F.col("most_excess"))
        stays = several(stays.join(ends, F.col("bucket") == F.col("of")).filter(reach <= within).drop("of", "least_total", "most_excess"))
        members = steps.put(stays if by_shingle is None else stays.unionByName(several(by_shingle)))
        steps.drop(pivots, rest, split, folded, by_shingle)
        if members.isEmpty():
            return maps
        turn += 1


def _first_pairs(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Each text with the distinct pivots of all its buckets that come before it: (a, b, label_a, label_b).

    A text is in BANDS buckets at most, of a few pivots each, and copies meet the same pivots in many of them; so these
    are folded per text before they become rows.
    """
    heads = pivots.groupBy("of").agg(F.collect_list(F.struct("place_a", "node_a", "label_a")).alias("heads"))
    met = members.join(heads, F.col("bucket") == F.col("of")).groupBy("node", "label", "place")
    met = met.agg(F.array_distinct(F.flatten(F.collect_set("heads"))).alias("heads"))
    before = F.filter(
        "heads",
        lambda h: (h["label_a"] != F.col("label"))
        & ((h["place_a"] < F.col("place")) | ((h["place_a"] == F.col("place")) & (h["node_a"] < F.col("node")))),
    )
    pairs = met.select("node", "label", F.explode(before).alias("head"))
    return pairs.select(F.col("head.node_a").alias("a"), F.col("node").alias("b"), F.col("head.label_a").alias("label_a"), F.col("label").alias("label_b"))


def _later_pairs(members: DataFrame, pivots: DataFrame, within: float) -> DataFrame:
    """As `_first_pairs`, for buckets of shingles, of which a text may have many: without the pairs that the bound excludes.

    Pivots are met in lists of HEADS. They are folded over parts of some PART_BUCKETS of a text's buckets, so that no
    list grows with the length of the text; only a text with more buckets meets a pivot in several parts.
    """
    sizes = members.groupBy(F.col("node").alias("__node")).agg(F.ceil(F.count(F.lit(1)) / PART_BUCKETS).alias("parts"))
    head = F.struct(*(f"{n}_a" for n in ["node", "label", "place", *MEASURES]))
    lists = pivots.groupBy("of", F.floor((F.col("rank") - 1) / HEADS).alias("list")).agg(F.collect_list(head).alias("heads"))

    def open_pair(h):
        alone = (
            F.least(F.lit(1.0), F.col("inside"), (h["met_a"] + F.col("excess")) / F.col("total")),
            F.least(F.lit(1.0), h["inside_a"], (F.col("met") + h["excess_a"]) / h["total_a"]),
        )
        bound = sum(1.0 / F.greatest(share, F.lit(1e-9)) for share in alone)
        before = (h["place_a"] < F.col("place")) | ((h["place_a"] == F.col("place")) & (h["node_a"] < F.col("node")))
        return (h["label_a"] != F.col("label")) & before & (F.col("inside").isNull() | h["inside_a"].isNull() | (bound <= within))

    left = F.transform(F.filter("heads", open_pair), lambda h: F.struct(h["node_a"].alias("a"), h["label_a"].alias("label_a")))
    met = members.join(lists, F.col("bucket") == F.col("of")).select("node", "label", "bucket", "list", left.alias("heads")).filter(F.size("heads") > 0)
    part = F.pmod("bucket", "parts").alias("part")
    parts = met.join(sizes, F.col("node") == F.col("__node")).groupBy("node", "label", "list", part)
    folded = parts.agg(F.array_distinct(F.flatten(F.collect_set("heads"))).alias("heads"))
    pairs = folded.select("node", "label", F.explode("heads").alias("head"))
    return pairs.select("head.a", F.col("node").alias("b"), "head.label_a", F.col("label").alias("label_b")).distinct()


def folded_shingles(split: DataFrame) -> DataFrame:
    """node, label and the distinct shingles outside the pivots of any of a text's buckets.

    The same shingles come from many buckets of a text, and two texts need to meet at a shingle once only, so
    they are folded per text before they become rows: first over parts of its buckets, then over these.
    """
    united = F.array_distinct(F.flatten(F.collect_set("first"))).alias("first")
    parts = split.groupBy("node", "label", F.pmod("bucket", F.lit(FOLDS)).alias("part")).agg(united)
    return parts.groupBy("node", "label").agg(united)


def outside_buckets(folded: DataFrame) -> DataFrame:
    """(bucket, node, label): a bucket for each shingle of `folded(node, label, first)` that another text has.

    Shingles that no other text has lead nowhere; most are left out before they become rows, by a table of hashed
    slots that more than one text fills. It has a fixed size: where it fills up, more shingles become rows, and none
    that two texts share is lost.
    """
    twice = shared_slots(folded)

    def kept(batches):
        for batch in batches:
            lists = batch.column(2)
            values, cuts = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            keep = twice[_slots(values.to_numpy(zero_copy_only=False))]
            ends = np.concatenate(([0], np.cumsum(keep)))[cuts].astype(np.int32)
            shared = pa.ListArray.from_arrays(pa.array(ends), values.filter(pa.array(keep)))
            yield pa.record_batch([batch.column(0), batch.column(1), shared], ["node", "label", "first"])

    shared = folded.mapInArrow(kept, "node binary, label binary, first array<bigint>")
    shingle = shared.select("node", "label", F.explode("first").alias("shingle"))
    return shingle.select(F.xxhash64(F.lit("outside"), "shingle").alias("bucket"), "node", "label")


def _slots(values: np.ndarray) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - SEEN_BITS)).astype(np.int64)


def shared_slots(folded: DataFrame) -> np.ndarray:
    """Whether more than one shingle of `folded(first)` falls into a slot; each text has a shingle once."""
    size = 1 << SEEN_BITS

    def packed(once, twice):
        rows = [[TaskContext.get().partitionId()], [np.packbits(once).tobytes()], [np.packbits(twice).tobytes()]]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("part", "once", "twice"), rows, (pa.int32(), pa.binary(), pa.binary()))})

    def seen(batches):
        count = np.zeros(size, np.uint8)
        for batch in batches:
            met = np.bincount(_slots(batch.column(0).flatten().to_numpy(zero_copy_only=False)), minlength=size)
            count = np.minimum(count + np.minimum(met, 2).astype(np.uint8), 2)
        yield packed(count > 0, count > 1).to_batches()[0]

    def merged(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(size, bool), np.zeros(size, bool)
        for a, b in zip(table.column("once").to_pylist(), table.column("twice").to_pylist()):
            more, again = (np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in (a, b))
            once, twice = once | more, twice | again | (once & more)
        return packed(once, twice)

    schema = "part int, once binary, twice binary"
    parts = folded.select("first").mapInArrow(seen, schema).withColumn("set", F.pmod("part", F.lit(SEEN_GROUPS)))
    rows = parts.groupBy("set").applyInArrow(lambda t: merged(t), schema).collect()
    once, twice = np.zeros(size, bool), np.zeros(size, bool)
    for r in rows:
        more, again = (np.unpackbits(np.frombuffer(bytes(x), np.uint8)).astype(bool) for x in (r.once, r.twice))
        once, twice = once | more, twice | again | (once & more)
    return twice


def several(members: DataFrame) -> DataFrame:
    """The buckets that hold more than one label."""
    ends = members.groupBy(F.col("bucket").alias("__of")).agg(F.min("label").alias("__low"), F.max("label").alias("__high"))
    return members.join(ends.filter("__low != __high").select("__of"), F.col("bucket") == F.col("__of")).drop("__of")


def _with_pivots(fresh: DataFrame, pivots: DataFrame, texts: DataFrame) -> DataFrame:
    """Members of each bucket dealt over salts, and the bucket's first pivots in each of these, with texts."""
    salts = F.ceil(F.col("size") / float(SALTED)).cast("int")
    rows = fresh.select("bucket", F.pmod(F.xxhash64(F.lit(5), "node"), salts).cast("int").alias("salt"), F.lit(False).alias("pivot"), "node", "label")
    wanted = fresh.select(F.col("bucket").alias("__bucket")).distinct()
    heads = pivots.filter(F.col("rank") <= UNITED).join(wanted, F.col("of") == F.col("__bucket"), "left_semi")
    heads = heads.select(
        F.col("of").alias("bucket"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(True).alias("pivot"),
        F.col("node_a").alias("node"), F.col("label_a").alias("label"),
    )
    named = texts.select(F.col("node").alias("__node"), "text")
    return rows.unionByName(heads).join(named, F.col("node") == F.col("__node")).drop("__node")


def merged_labels(links: DataFrame, rows: int = 0) -> DataFrame:
    """New label of every label in `links(label_a, label_b)`: (old, new).

    A member's links all lead to pivots, so the components are found among the few pivots: each
    member takes its least one, and its others are linked to that.
    """
    steps = Narrow(links.sparkSession, rows)
    low = steps.put(links.groupBy("label_b").agg(F.min("label_a").alias("low")))
    others = links.join(low.withColumnRenamed("label_b", "of"), F.col("label_b") == F.col("of")).filter("label_a != low")
    pivots = links.select(F.col("label_a").alias("of")).distinct()
    chained = low.join(pivots, F.col("label_b") == F.col("of"), "left_semi")
    core = steps.put(
        others.select(F.col("low").alias("a"), F.col("label_a").alias("b"))
        .unionByName(chained.select(F.col("low").alias("a"), F.col("label_b").alias("b")))
        .distinct()
    )
    mine = low.select(F.col("label_b").alias("old"), F.col("low").alias("new"))
    if core.isEmpty():
        return mine
    labels = components(core, rows)
    mine = relabelled(mine.withColumnRenamed("new", "label"), [labels.select(F.col("node").alias("old"), F.col("label").alias("new"))])
    roots = labels.join(low.select(F.col("label_b").alias("of")), F.col("node") == F.col("of"), "left_anti")
    return steps.put(mine.withColumnRenamed("label", "new").unionByName(roots.select(F.col("node").alias("old"), F.col("label").alias("new"))))


def relabelled(rows: DataFrame, maps: list[DataFrame]) -> DataFrame:
    """`rows` with `label` passed through the maps; labels a map does not have stay."""
    for step in maps:
        own = step.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
        rows = rows.join(own, F.col("label") == F.col("__old"), "left").withColumn("label", F.coalesce("__new", "label")).drop("__old", "__new")
    return rows


def _labelled(worded: DataFrame, least: float) -> DataFrame:
    """node, least_id, rows and the label of its class for every exact text of `worded(doc_id, text, node, bands)`."""
    # any row of an exact text stands for all: their bands are the same
    nodes = written(
        worded.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("rows"), F.first("bands").alias("bands"))
    )
    bucketed = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "node")
    rows = BANDS * nodes.count()
    members = written(several(bucketed.withColumn("label", F.col("node"))))
    named = nodes.select("node", "least_id", "rows", F.col("node").alias("label"))
    if not members.isEmpty():
        wanted = members.select(F.col("node").alias("of")).distinct()
        texts = worded.select("node", "text").join(wanted, F.col("node") == F.col("of"), "left_semi").dropDuplicates(["node"])
        named = relabelled(named, near_links(members, written(texts), least, rows))
    return written(named)


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, class_id, class_size for every row of `docs(doc_id, text)`.

    Rows are alike if their words are the same (A-Z in lower case, any white space); texts are
    linked from a probability Jaccard of their weighted five-word shingles of `least`. A class
    is a connected component of rows, its id the smallest doc_id in it. A text without words
    (null, empty) is alone: its class is its own doc_id, and repeated rows of it count one each. A null doc_id
    is smaller than none. Repeated rows get a row each. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    signed = written(_signed(docs.select("doc_id", "text")))
    alone = signed.filter("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    worded = signed.filter("node is not null")
    named = _labelled(worded, least)
    classes = named.groupBy(F.col("label").alias("of")).agg(F.min("least_id").alias("class_id"), F.sum("rows").alias("class_size"))
    by_node = named.join(classes, F.col("label") == F.col("of")).select(F.col("node").alias("of_node"), "class_id", "class_size")
    grouped = worded.select("doc_id", "node").join(by_node, F.col("node") == F.col("of_node")).select("doc_id", "class_id", "class_size")
    return grouped.unionByName(alone)


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row of each class of `docs`, with all its columns: that of the smallest doc_id, null last, and smallest node.

    The row is found by its class, not by doc_id: rows that share a doc_id or have none are in the classes of their
    texts. A text without words is a class of its own; of such rows alike in doc_id and text one stays.
    """
    small_batches(docs.sparkSession)
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    signed = written(_signed(docs.select("doc_id", "text", rest)))
    worded = signed.filter("node is not null")
    first = F.min(F.struct(F.col("least_id").isNull().alias("unnamed"), "least_id", "node")).alias("head")
    heads = _labelled(worded, least).groupBy("label").agg(first).select(F.col("head.node").alias("of"), F.col("head.least_id").alias("id"))
    rows = worded.select("doc_id", "text", "rest", "node")
    picked = rows.join(heads, (F.col("node") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").dropDuplicates(["node"])
    wordless = signed.filter("node is null").select(*rows.columns).dropDuplicates(["doc_id", "text"])
    return picked.unionByName(wordless).select(*["text" if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])
