"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm.common import written
from playledger.llm.words import mix

LEAF_ROWS = 4096
FAN_IN = 16
MOST_COPIES = 2.0
PART_BITS = 56
_ROUNDED = "source string, doc_id long, seed long, size long, whole long, part double, leaf long"
_EDGE = 1e-9


def word_count(text="text"):
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null."""
    squeezed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "\u0001")
    return F.length(squeezed) - F.length(F.translate(squeezed, "\u0001", ""))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float) -> DataFrame:
    """Targets per source of `sizes(source, size)`: source, source_size, target.

    Sources by code point, null last, take `weights` in turn and share `budget` times all sizes;
    a target stops at twice its source's size and the rest is shared again. Only the sums of
    each round of sharing reach the driver; a round fixes one source or more. One row per source
    is ranked in one window; everything per document stays spread.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = written(
        per_source.select(
            "source",
            "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("weight"),
            (F.col("source_size") * MOST_COPIES).alias("most"),
        )
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    rate = 0.0
    while True:
        full = F.col("most") <= F.lit(rate) * F.col("weight")
        row = ranked.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row.open:
            break
        new = (budget * total - row.fixed) / row.open
        if new <= rate:
            break
        rate = new
    return ranked.select("source", "source_size", F.least("most", F.lit(rate) * F.col("weight")).alias("target"))


def _uniform(seeds: np.ndarray, salt: int) -> np.ndarray:
    return (mix(seeds.astype(np.uint64) + np.uint64(salt)) >> np.uint64(11)).astype(np.float64) / 2.0**53


def pivot(frame: pd.DataFrame, level: int) -> pd.DataFrame:
    """Pairs documents in order of size and moves mass between two until one is whole.

    The walk keeps the sum of parts and each part's expectation; documents next to each other
    have near sizes, so the words taken hardly move. At most one row keeps a part.
    """
    frame = frame.sort_values(["size", "seed"], ascending=[False, True], kind="stable")
    part, whole = frame["part"].to_numpy(copy=True), frame["whole"].to_numpy(copy=True)
    chance = _uniform(frame["seed"].to_numpy(), 0x51ED + level)
    held = -1
    for i in range(len(part)):
        if part[i] == 0.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = part[held], part[i]
        total = a + b
        if total < 1.0:  # one of them drops to nothing
            a, b = (total, 0.0) if chance[i] * total < a else (0.0, total)
        else:  # one of them gains a whole copy
            a, b = (1.0, total - 1.0) if chance[i] * (2.0 - total) < 1.0 - b else (total - 1.0, 1.0)
        for at, value in ((held, a), (i, b)):
            near = round(value)
            if abs(value - near) < _EDGE:
                whole[at] += near
                value = 0.0
            part[at] = value
        held = held if part[held] > 0.0 else i if part[i] > 0.0 else -1
    return frame.assign(part=part, whole=whole)


def mix_copies(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Copies per row of `sized(doc_id, source, size)` towards `targets`: adds source_size, target, copies.

    The wanted copies of a row are target / source_size; the whole part is given, the rest is
    settled by pivotal rounding: in leaves of some LEAF_ROWS rows of one source, dealt by a hash
    of doc_id and text (`order`, where given) so that a hot source, or many rows without an id, spread, then by a tree that combines the leaves' residues
    FAN_IN at a time. Nothing depends on how Spark lays out rows, so reruns agree. Rows of size
    0 get none. Null sources are a source; null doc_ids are kept; repeated rows are each rounded.
    """
    rows = sized.select("doc_id", "source", "size", *(c for c in ["order"] if c in sized.columns))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    n_rows = rows.filter("size > 0").count()
    n_leaves = max(1, -(-n_rows // LEAF_ROWS))
    rows = (
        rows.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("wanted", wanted)
        .withColumn("seed", F.xxhash64(F.lit(17), "doc_id", *(c for c in ["order", "size"] if c in rows.columns)))
    )
    start = rows.filter("size > 0").select(
        "source",
        "doc_id",
        "seed",
        "size",
        F.floor(F.col("wanted") + _EDGE).alias("whole"),
        F.greatest(F.lit(0.0), F.col("wanted") - F.floor(F.col("wanted") + _EDGE)).alias("part"),
        F.pmod(F.xxhash64("seed"), F.lit(n_leaves)).alias("leaf"),
    )
    done, level = [], 0
    while True:
        step = level

        def settle(frame: pd.DataFrame) -> pd.DataFrame:
            return pivot(frame, step)

        settled = written(start.groupBy("source", "leaf").applyInPandas(settle, _ROUNDED))
        done.append(settled.filter("part = 0"))
        rest = settled.filter("part > 0")
        if n_leaves == 1:
            break
        n_leaves, level = -(-n_leaves // FAN_IN), level + 1
        start = rest.withColumn("leaf", F.floor(F.col("leaf") / FAN_IN))
    # the one residue left of each source is rounded by its own chance
    last = rest.withColumn("whole", F.col("whole") + F.when(_chance("seed") < F.col("part"), 1).otherwise(0))
    done.append(last)
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    settled = settled.select("doc_id", "source", "size", F.col("whole").alias("copies"))
    none = rows.filter("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("copies"))
    out = settled.unionByName(none)
    known = targets.withColumnRenamed("source", "of")
    return out.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _chance(seed: str):
    return F.pmod(F.xxhash64(F.lit(91), seed), F.lit(1 << 30)) / float(1 << 30)


def mixed_sizes(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document."""
    sized = written(docs.select("doc_id", "source", word_count().cast("long").alias("size"), F.xxhash64("text").alias("order")))
    mixed = mix_copies(sized, source_targets(sized, weights, budget))
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def take_mixture(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5) -> DataFrame:
    """The documents themselves, with all their columns, each as often as the mixture takes it.

    Copies are counted per doc_id, source and size; rows alike in these share their copies, so
    that a repeated row gets the mean of them, the first ones by a hash of the text one more.
    Rows alike are ranked in parts by the hash's first bits, so that many without a doc_id spread. Texts are shuffled
    once: to the copies of their part, whose rows are ranked where they meet them.
    """
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    order = F.xxhash64("text")
    sized = docs.select("doc_id", "source", word_count().cast("long").alias("size"), order.alias("order"), F.shiftright(order, PART_BITS).alias("part"), "text", rest)
    slim = written(sized.select("doc_id", "source", "size", "order", "part"))
    mixed = mix_copies(slim, source_targets(slim, weights, budget))
    of_key = ["doc_id", "source", "size"]
    shares = mixed.groupBy(*of_key).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).filter("copies > 0")
    shares = shares.select(*(F.col(c).alias(f"of_{c}") for c in of_key), "copies", "rows")
    # how many rows of the same key stand before a part: a key has at most 2 ** (64 - PART_BITS) parts
    here = slim.groupBy(*of_key, "part").agg(F.count(F.lit(1)).alias("here"))
    known = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in of_key]
    before = F.sum("here").over(Window.partitionBy(*of_key).orderBy("part")) - F.col("here")
    parts = here.join(shares, known[0] & known[1] & known[2]).withColumn("before", before)
    parts = written(parts.select(_part_key().alias("of"), "copies", "rows", "before"))
    rank = F.row_number().over(Window.partitionBy("of").orderBy("order")) + F.col("before")
    more = F.when(rank <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    met = sized.withColumn("key", _part_key()).join(parts, F.col("key") == F.col("of"))
    times = met.withColumn("times", (F.floor(F.col("copies") / F.col("rows")) + more).cast("int")).filter("times > 0")
    taken = times.select("text", "rest", F.explode(F.sequence(F.lit(1), "times")).alias("copy"))
    return taken.select(*["text" if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def _part_key():
    """doc_id, source, size and part as one text, the same for no two of them; nulls are values."""
    name = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source"))
    return F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size", "part", name)
