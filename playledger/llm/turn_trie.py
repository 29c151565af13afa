"""Prefix trie of conversations, built by halving the depth (van Emde Boas recursion).

A sequence of turns is cut into blocks of BLOCK turns, and the sequence of blocks is cut at half its
depth again and again. What is above a cut is the upper trie, what hangs below it a forest of lower tries, and
a cut prefix is known to both by its name, a 128-bit digest. All pieces of one size are handled in one
step: names are given from the whole depth down, totals are summed inside the small tries first and then
grafted onto the tries above. So the number of steps grows with the logarithm of the longest
conversation, and no step gathers a conversation, a node's members or its children in one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import written

BLOCK = 8
"""Turns in a trie that is not cut any more."""
PIECE_BYTES = 8 << 10
ROOT = bytes(16)
_TOTALS = ("n_leaves", "saved_tokens")


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 0), key, size of every turn: ordered by turn (null first), then role and key.

    Null roles and texts become empty; `key` names (role, text), `size` is the number of code points of the text. Rows
    without conv_id take no part; repeated rows are turns of their own. Turns are numbered in a range sort, so that one
    conversation may lie in many tasks; what its earlier tasks hold is added from a table of one row per task at most.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("key"),
        F.length(text).cast("long").alias("size"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "key"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(dealt.select("conv_id", "key", "size", F.monotonically_increasing_id().alias("place")))
    # the upper bits of a place are its task; a conversation is in neighbouring tasks only
    placed = placed.withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    spans = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "first", "n"))).alias("runs"))
    before = "aggregate(slice(runs, 1, i), 0L, (s, r) -> s + r.n)"
    starts = spans.select(
        F.col("conv_id").alias("of"),
        F.explode(F.expr(f"transform(runs, (run, i) -> struct(run.part as in_part, run.first as first, {before} as before))")).alias("run"),
    ).select("of", "run.*")
    joined = placed.join(starts, (F.col("conv_id") == F.col("of")) & (F.col("part") == F.col("in_part")))
    return joined.select("conv_id", (F.col("place") - F.col("first") + F.col("before")).alias("at"), "key", "size")


def rebuilt_turns(turns: DataFrame, head_turns: Column, donor: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first `head_turns` turns of conversation `donor` in place of their own.

    Both are columns of conv_id. All of the donor's turns if it has fewer, none if it is absent. Returns the
    conversations (conv_id, length) and their turns (conv_id, length, at, key, size).
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    own = own.withColumn("head", head_turns.cast("int")).withColumn("donor", donor)
    longest = own.agg(F.max("head")).first()[0] or 0
    heads = turns.filter(F.col("at") < longest).groupBy(F.col("conv_id").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("at", "key", "size"))).alias("first")
    )
    convs = own.join(heads, F.col("donor") == F.col("of"), "left").withColumn(
        "first", F.when(F.col("head") > 0, F.slice(F.col("first"), F.lit(1), F.col("head")))
    )
    n_head = F.when(F.col("first").isNull(), 0).otherwise(F.size("first")).cast("long")
    length = n_head + F.greatest(F.lit(0).cast("long"), F.col("n_own") - F.col("head"))
    convs = written(convs.select("conv_id", length.alias("length"), n_head.alias("n_head"), "head", "first"))
    taken = convs.select("conv_id", "length", F.inline("first"))
    mine = convs.select(F.col("conv_id").alias("of"), "length", "n_head", "head")
    kept = turns.join(mine, F.col("conv_id") == F.col("of")).filter(F.col("at") >= F.col("head"))
    kept = kept.select("conv_id", "length", (F.col("at") - F.col("head") + F.col("n_head")).alias("at"), "key", "size")
    return convs.select("conv_id", "length"), taken.unionByName(kept)


def cut_names(blocks: DataFrame, convs: DataFrame, most: int) -> DataFrame:
    """Names of all prefixes of whole blocks, the empty one included: (conv_id, b, name).

    Upwards, a run of 2**k blocks is named by its two halves. Downwards, the prefix that ends at the cut
    of a run is named by the prefix before the run and the name of the run's upper half; so equal
    prefixes have equal names, whatever stands below.
    """
    levels = most.bit_length()
    runs = [written(blocks.filter(F.size("keys") == BLOCK).select("conv_id", "b", _digest(*(F.col("keys")[i] for i in range(BLOCK))).alias("name")))] if levels else []
    for k in range(1, levels):
        half = F.when(F.pmod("b", F.lit(1 << k)) == 0, 0).otherwise(1)
        halves = runs[-1].groupBy("conv_id", F.shiftleft(F.shiftright("b", k), k).alias("b")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("upper"), F.max(F.when(half == 1, F.col("name"))).alias("lower")
        )
        runs.append(written(halves.filter("upper is not null and lower is not null").select("conv_id", "b", _digest(F.col("upper"), F.col("lower")).alias("name"))))
    names = convs.select("conv_id", F.lit(0).cast("long").alias("b"), F.lit(ROOT).alias("name"))
    for k in reversed(range(levels)):
        run = runs[k].filter(F.pmod(F.shiftright("b", k), F.lit(2)) == 0).select(
            F.col("conv_id").alias("of"), F.col("b").alias("at"), F.col("name").alias("run")
        )
        cut = names.join(run, (F.col("conv_id") == F.col("of")) & (F.col("b") == F.col("at"))).select(
            "conv_id", (F.col("b") + (1 << k)).alias("b"), _digest(F.col("name"), F.col("run")).alias("name")
        )
        names = written(names.unionByName(cut))
    return names


def prefix_rows(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """One row per turn: (conv_id, depth, name, parent, above, size, ends), the cut names, and the most blocks.

    `above` has the names of the prefixes from the block's start to the parent, eight at most; `ends`
    says that the conversation ends there.
    """
    most = (convs.agg(F.max("length")).first()[0] or 0) // BLOCK
    blocks = turns.groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("b")).agg(
        F.array_sort(F.collect_list(F.struct("at", "key", "size"))).alias("turns"), F.first("length").alias("length")
    )
    blocks = written(blocks.select("conv_id", "b", "length", F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes")))
    cuts = written(cut_names(blocks, convs, most))
    opens = cuts.select(F.col("conv_id").alias("c0"), F.col("b").alias("b0"), F.col("name").alias("open"))
    closes = cuts.select(F.col("conv_id").alias("c1"), (F.col("b") - 1).alias("b1"), F.col("name").alias("close"))
    both = blocks.join(opens, (F.col("conv_id") == F.col("c0")) & (F.col("b") == F.col("b0"))).join(
        closes, (F.col("conv_id") == F.col("c1")) & (F.col("b") == F.col("b1")), "left"
    )
    chain = "aggregate(slice(keys, 1, least(size(keys), {last})), array(open), (names, key) -> concat(names, array(unhex(md5(concat(element_at(names, -1), key))))))"
    named = both.withColumn("names", F.expr(chain.format(last=BLOCK - 1))).withColumn(
        "names", F.when(F.size("keys") == BLOCK, F.concat("names", F.array("close"))).otherwise(F.col("names"))
    )
    rows = named.select("conv_id", "b", "length", "names", F.posexplode("sizes").alias("i", "size")).select(
        "conv_id",
        (F.col("b") * BLOCK + F.col("i") + 1).alias("depth"),
        F.col("names")[F.col("i") + 1].alias("name"),
        F.col("names")[F.col("i")].alias("parent"),
        F.slice("names", F.lit(1), F.col("i") + 1).alias("above"),
        "size",
        (F.col("b") * BLOCK + F.col("i") + 1 == F.col("length")).alias("ends"),
    )
    return written(rows), cuts, most


def _sums(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy(*names).agg(*(F.sum(t).alias(t) for t in _TOTALS))


def _grafted(tops: DataFrame, sent: DataFrame) -> DataFrame:
    """Totals of `tops(name, b)` with those sent to them added; what is sent to other names is not used."""
    added = _sums(sent, "name").select(F.col("name").alias("of"), *(F.col(t).alias(f"{t}_sent") for t in _TOTALS))
    plus = [(F.col(t) + F.coalesce(F.col(f"{t}_sent"), F.lit(0))).alias(t) for t in _TOTALS]
    return tops.join(added, F.col("name") == F.col("of"), "left").select("name", "b", *plus)


def cut_totals(tops: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """Totals of the whole subtree of every cut prefix, from those of its own block: `tops(name, b, totals)`.

    `anchors(name, k, anchor)` has the prefix 2**k blocks above for all k for which 2**k divides b. Upwards, the tries
    below a cut are summed into the trie above that has the same height; downwards, cuts between two known ones take
    what hangs below them.
    """
    levels = most.bit_length()
    done, open_tops = [], tops

    def sent(rows: DataFrame, k: int) -> DataFrame:
        to = anchors.filter(F.col("k") == k).select(F.col("name").alias("of"), "anchor")
        return rows.join(to, F.col("name") == F.col("of")).select(F.col("anchor").alias("name"), *_TOTALS)

    for k in range(levels):
        odd = F.pmod(F.shiftright("b", k), F.lit(2)) == 1
        done.append(open_tops.filter(odd))
        open_tops = written(_grafted(open_tops.filter(~odd), sent(done[k], k)))
    known = open_tops
    for k in reversed(range(levels)):
        known = written(known.unionByName(_grafted(done[k], sent(known, k))))
    return known


def member_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each name in `ends(name, conv_id)`: (name, ends_sha256).

    Ids are joined into pieces in a range sort, so that one name may lie in many tasks; the few pieces of a
    name then pass through one hash state, and no list of members is held.
    """

    def joined(batches):
        name, first, ids, held = None, None, [], 0
        for batch in batches:
            out = []
            for of, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if of != name or held >= PIECE_BYTES:
                    if ids:
                        out.append((name, first, ",".join(ids)))
                    name, first, ids, held = of, conv, [], 0
                ids.append(str(conv))
                held += len(ids[-1]) + 1
            yield _columns(out, ("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string()))
        if ids:
            yield _columns([(name, first, ",".join(ids))], ("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string()))

    def hashed(batches):
        name, state = None, None
        fields = ("name", pa.binary()), ("ends_sha256", pa.string())
        for batch in batches:
            out = []
            for of, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if of != name:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = of, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _columns(out, *fields)
        if state:
            yield _columns([(name, state.hexdigest())], *fields)

    dealt = ends.select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = written(dealt.mapInArrow(joined, "name binary, first long, ids string"))
    return pieces.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name binary, ends_sha256 string")


def _columns(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields])


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of `convs(conv_id, length)` with `turns(conv_id, length, at, key, size)`.

    One row per distinct sequence of first turns, the empty one included: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Without conversations there is no node.
    """
    convs = convs.select("conv_id", "length")
    rows, cuts, most = prefix_rows(turns, convs)
    nodes = rows.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *(F.first(c).alias(c) for c in ("depth", "parent", "above", "size"))
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("name"), "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.array().cast("array<binary>").alias("above"), F.lit(0).cast("long").alias("size"),
    )
    nodes = written(nodes.unionByName(root))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.join(nodes.select(F.col("name").alias("own"), F.col("conv_id").alias("first")), F.col("of") == F.col("own"))
    children = written(children.select("of", "n_children", "first"))
    counted = nodes.join(children.select("of", "n_children"), F.col("name") == F.col("of"), "left").drop("of")
    counted = counted.join(children.select("of", F.col("first").alias("parent_conv_id")), F.col("parent") == F.col("of"), "left").drop("of")
    n_children = F.coalesce("n_children", F.lit(0)).cast("long")
    counted = written(
        counted.withColumn("n_children", n_children)
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("size"))
    )
    cut = F.pmod("depth", F.lit(BLOCK)) == 0
    own = counted.select("name", *_TOTALS)
    inside = counted.filter(~cut).select(F.explode("above").alias("name"), *_TOTALS)
    blockwise = written(_sums(own.unionByName(inside), "name"))
    heads = counted.filter(cut).select(F.col("name").alias("of"), "conv_id", F.floor(F.col("depth") / BLOCK).alias("b"), "above")
    heads = written(heads.join(blockwise, F.col("of") == F.col("name")).drop("of"))
    totals = cut_totals(heads.select("name", "b", *_TOTALS), _anchors(heads, cuts, most), most)
    # the tries below a block hang on its last prefixes and count for all prefixes in between
    hung = heads.select(F.col("name").alias("of"), F.slice("above", 2, BLOCK - 1).alias("between")).filter(F.size("between") > 0)
    hung = totals.join(hung, F.col("name") == F.col("of")).select(F.explode("between").alias("name"), *_TOTALS)
    between = blockwise.join(heads.select(F.col("name").alias("of")), F.col("name") == F.col("of"), "left_anti")
    totals = totals.select("name", *_TOTALS).unionByName(_sums(between.unionByName(hung), "name"))
    ends = rows.filter("ends").select("name", "conv_id")
    ends = ends.unionByName(convs.filter("length = 0").select(F.lit(ROOT).alias("name"), "conv_id"))
    digests = member_digests(ends).select(F.col("name").alias("ended"), "ends_sha256")
    return (
        counted.drop(*_TOTALS)
        .join(totals.withColumnRenamed("name", "of"), F.col("name") == F.col("of"))
        .join(digests, F.col("name") == F.col("ended"), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def _anchors(heads: DataFrame, cuts: DataFrame, most: int) -> DataFrame:
    """(name, k, anchor) of cut prefixes: the prefix 2**k blocks above, as one of their members has it."""
    steps = F.sequence(F.lit(0), F.lit(max(0, most.bit_length() - 1)))
    asked = heads.filter("b > 0").select("name", "conv_id", "b", F.explode(steps).alias("k")).withColumn("step", F.expr("shiftleft(1L, k)"))
    asked = asked.filter(F.pmod("b", "step") == 0).select("name", "k", F.col("conv_id").alias("of"), (F.col("b") - F.col("step")).alias("at"))
    above = cuts.select("conv_id", "b", F.col("name").alias("anchor"))
    return written(asked.join(above, (F.col("of") == F.col("conv_id")) & (F.col("at") == F.col("b"))).select("name", "k", "anchor"))


def prefix_trie(conversations: DataFrame, head_turns: Column, donor: Column) -> DataFrame:
    """The trie of the conversations rebuilt by `head_turns` and `donor` (see `rebuilt_turns`, `trie`).

    `conversations(conv_id, turn, role, text)`; other columns are ignored, names that clash with inner ones too.
    """
    turns = written(numbered_turns(conversations.select("conv_id", "turn", "role", "text")))
    return trie(*rebuilt_turns(turns, head_turns, donor))
