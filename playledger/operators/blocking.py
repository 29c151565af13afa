"""Exact similarity join on the indel ratio, blocked by shared substrings.

Two texts of length n and m whose ratio rounds to `cutoff` or more lie within
`t = (201 - 2*cutoff) * (n + m) / 200` insertions and deletions. Cut one text into `D + 1`
pieces, D being t for its longest admissible partner: some piece j occurs unchanged in the
other text with exactly j edits before it and at most D - j after it (after Li et al.,
"Pass-Join", VLDB 2011: the edits before piece j, less j, start at 0, end below 0 and fall by
one only over an unchanged piece). So instead of comparing all pairs, both sides meet in an
equi-join on (length, piece number, piece text). The number of edits also fixes by how much,
up to parity, a piece has moved.

A piece that very many texts share would still bring them all together. Such a block is not
joined. The rest of its texts, left and right of the piece, is cut again under the edit
budgets that remain, which gives a longer shared key, and so on until the blocks are small.
Every true pair stays findable at each step, so nothing is dropped or capped.

A state row is a text with the parts of it that are still open:
`parts array<struct<at, len, span, edits>>` - where the part starts in this text, its length,
the length of the candidate's part and its number of edits (exact, but at most for the last
part of the text). A query row also has `spare`, the edits its own length leaves unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.functions.similarity import indel_distance
from playledger.session import ensure_checkpoint_dir

MAX_BLOCK = 50
_PARTS = "array<struct<at: int, len: int, span: int, edits: int>>"


def _slack(cutoff: int) -> int:
    """Edits allowed per 200 characters of both texts; 9 at the cutoff of 96."""
    if not 96 <= cutoff <= 100:
        raise ValueError("the blocked join is exact for cutoffs from 96 to 100 only")
    return 201 - 2 * cutoff


def _longest_partner(length: str, slack: int) -> str:
    return f"((200 + {slack}) * {length}) div (200 - {slack})"


def _shortest_partner(length: str, slack: int) -> str:
    return f"((200 - {slack}) * {length} + 199 + {slack}) div (200 + {slack})"


def _allowed(total: str, slack: int) -> str:
    return f"cast(({slack} * ({total})) div 200 as int)"


def _budget(length: str, slack: int) -> str:
    """Edits allowed between a text and its longest partner; depends on its length alone."""
    return _allowed(f"{length} + {_longest_partner(length, slack)}", slack)


def rounded_ratio(edits: Column, total: Column) -> Column:
    """Indel ratio out of 100, rounded half up."""
    return F.floor((1 - edits / total) * 100 + 0.5).cast("int")


def _candidate_states(candidates: DataFrame, slack: int) -> DataFrame:
    """One open part, the whole text; texts without room for an edit match by equality only."""
    return (
        candidates.withColumn("m", F.length("text"))
        .withColumn("budget", F.expr(_budget("m", slack)))
        .where("budget >= 1")
        .withColumn("block", F.xxhash64("m"))
        .withColumn("parts", F.expr(f"cast(array(struct(0, m, m, budget)) as {_PARTS})"))
        .drop("m", "budget")
    )


def _query_states(queries: DataFrame, slack: int) -> DataFrame:
    """One row per admissible candidate length."""
    return (
        queries.withColumn("n", F.length("text"))
        .withColumn(
            "m",
            F.explode(
                F.expr(
                    f"sequence(cast({_shortest_partner('n', slack)} as int), "
                    f"cast({_longest_partner('n', slack)} as int))"
                )
            ),
        )
        .withColumn("edits", F.expr(_allowed("n + m", slack)))
        .withColumn("edits", F.expr("edits - (edits - abs(n - m)) % 2"))
        .where("edits >= 1")
        .withColumn("budget", F.expr(_budget("m", slack)))
        .withColumn("spare", F.expr("budget - edits"))
        .withColumn("block", F.xxhash64("m"))
        .withColumn("parts", F.expr(f"cast(array(struct(0, n, m, budget)) as {_PARTS})"))
        .drop("n", "m", "budget", "edits")
    )


# The part to cut next: the longest one that still gives every piece a character. Candidate
# lengths and budgets are the same on both sides of a pair, so both sides choose alike.
_NEXT_PART = (
    "array_max(transform(parts, (p, x) -> "
    "if(p.span > p.edits, struct(p.span as span, -x as place), null)))"
)


def _can_split() -> Column:
    return F.expr(f"{_NEXT_PART} is not null")


def _split(states: DataFrame, shifted: bool) -> DataFrame:
    """Cut the next part of every state; `shifted` tries all positions a piece may have moved to.

    The block grows by the piece together with any side of it that must match unchanged.
    """
    cut = (
        states.withColumn("place", F.expr(f"-{_NEXT_PART}.place"))
        .withColumn("part", F.expr("parts[place]"))
        .withColumn("piece", F.explode(F.expr("sequence(0, part.edits)")))
        .withColumn("size", F.expr("cast(part.span div (part.edits + 1) as int)"))
        .withColumn("small", F.expr("part.edits + 1 - part.span % (part.edits + 1)"))
        .withColumn("start", F.expr("piece * size + greatest(piece - small, 0)"))
        .withColumn("size", F.expr("size + if(piece >= small, 1, 0)"))
        .withColumn("after", F.expr("part.edits - piece"))
    )
    if shifted:
        gap = "(part.len - part.span)"
        last = "part.at + part.len = length(text)"
        cut = cut.withColumn("room", F.expr(f"after - if({last}, spare, 0)"))
        # From the lowest to the highest move, in steps of two.
        low = f"greatest(-piece, {gap} - room, -start)"
        low = f"({low} + abs({low} + piece) % 2)"
        high = f"least(piece, {gap} + room, part.len - size - start)"
        moves = f"if(room >= 0 and {low} <= {high}, sequence({low}, {high}, 2), array())"
        cut = cut.withColumn("shift", F.explode(F.expr(moves))).drop("room")
    else:
        cut = cut.withColumn("shift", F.lit(0))
    left = "named_struct('at', part.at, 'len', start + shift, 'span', start, 'edits', piece)"
    right = (
        "named_struct('at', part.at + start + shift + size, "
        "'len', part.len - start - shift - size, "
        "'span', part.span - start - size, 'edits', after)"
    )
    fixed_from = "if(piece = 0, part.at, part.at + start + shift)"
    fixed_to = "if(after = 0, part.at + part.len, part.at + start + shift + size)"
    opened = (
        f"concat(slice(parts, 1, place), "
        f"filter(array({left}, {right}), p -> p.edits > 0), "
        f"slice(parts, place + 2, size(parts)))"
    )
    fixed = F.expr(f"substring(text, {fixed_from} + 1, {fixed_to} - {fixed_from})")
    grown = F.xxhash64("block", "place", "piece", fixed)
    return cut.withColumns({"block": grown, "parts": F.expr(f"cast({opened} as {_PARTS})")}).drop(
        "place", "part", "piece", "size", "small", "start", "after", "shift"
    )


def _meet(queries: DataFrame, candidates: DataFrame, slack: int) -> DataFrame:
    """Pairs of a block that pass the length test and Spark's banded edit distance.

    Never broadcast, nor is any join below: one text is in many blocks, so a side that looks
    small compressed is large in the driver, and the joins of all rounds run at once.
    """
    left = queries.select("block", F.col("text").alias("query"))
    right = candidates.drop("parts").withColumnRenamed("text", "candidate")
    total = "length(query) + length(candidate)"
    allowed = _allowed(total, slack)
    return (
        left.join(right.hint("merge"), "block")
        .where(F.expr(f"abs(length(query) - length(candidate)) <= {allowed}"))
        .where(F.expr(f"levenshtein(query, candidate, {allowed}) >= 0"))
        .drop("block")
    )


def near_pairs(
    queries: DataFrame, candidates: DataFrame, cutoff: int, max_block: int = MAX_BLOCK
) -> DataFrame:
    """All pairs of unequal texts whose ratio rounds to at least `cutoff`.

    `queries(text)` and `candidates(text, ...)` hold distinct, non-empty texts. Returns
    `query, candidate, score` and the other candidate columns; a pair may repeat.
    """
    slack = _slack(cutoff)
    spark = queries.sparkSession
    asked, offered = _query_states(queries, slack), _candidate_states(candidates, slack)
    pairs = None
    ensure_checkpoint_dir(spark)
    while True:
        asked, offered = _split(asked, shifted=True), _split(offered, shifted=False)
        sizes = offered.where(_can_split()).groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
        probed = asked.where(_can_split()).select("block").distinct()
        crowded = sizes.where(F.col("rows") > max_block).join(probed.hint("merge"), "block", "left_semi")
        crowded = crowded.select("block").checkpoint()
        last = crowded.isEmpty()
        ready = offered
        if not last:
            splittable = offered.withColumn("_split", _can_split())
            ready = splittable.where("NOT _split").unionByName(
                splittable.where("_split").join(crowded.hint("merge"), "block", "left_anti")
            ).drop("_split")
        met = _meet(asked, ready, slack)
        pairs = met if pairs is None else pairs.unionByName(met)
        if last:
            break
        # Only crowded blocks go on; checkpoints keep the next round's plan short.
        asked = asked.where(_can_split()).join(crowded.hint("merge"), "block", "left_semi").checkpoint()
        offered = offered.where(_can_split()).join(crowded.hint("merge"), "block", "left_semi").checkpoint()
    total = F.length("query") + F.length("candidate")
    scored = pairs.withColumn("score", rounded_ratio(indel_distance("query", "candidate"), total))
    return scored.where((F.col("score") >= cutoff) & (F.col("query") != F.col("candidate")))
