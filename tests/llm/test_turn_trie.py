"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from playledger.llm import turn_trie
from playledger.llm.queries import QUERIES
from tests.conftest import rows

TURNS = "conv_id long, turn long, role string, text string, name string, b long"


def brute_nodes(turns):
    """Result rows from (conv_id, turn, role, text) tuples."""

    def order(turn, role, text):
        key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        return turn is not None, turn or 0, role, key

    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda t: order(*t))] for c, v in own.items()}
    whole = {}
    for conv, mine in own.items():
        head = zlib.crc32(str(conv).encode()) % 6
        whole[conv] = own.get(conv - int(math.fmod(conv, 100)), [])[:head] + mine[head:]
    members, children, totals, found = {}, {}, {}, []
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(totals[c][0] for c in below) or 1, saved + sum(totals[c][1] for c in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(members[node]), len(node), parent, len(members[node]), len(below), *totals[node], digest))
    return sorted(found, key=repr)


def nodes_of(frame):
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6))
    return turn_trie.prefix_trie(frame, head, F.col("conv_id") - F.col("conv_id") % 100)


def test_whole_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = QUERIES["op11_turn_trie"](spark, "/root/testdata/sf0.01")
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint"] * 7 + ["string"]
    assert rows(found) == brute_nodes([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("longest", [7, 8, 9, 70])
def test_long_conversations_that_part_late(spark, longest):
    """Lengths around a block and over several levels of cuts; copies; branches at every depth."""
    turns = [(100 + i // 3, j, "user", f"turn {j if j < longest // 2 else j + i // 5}", "x", 1) for i in range(9) for j in range(longest + 5 * i)]
    turns += [(200 + i, j, "user", f"turn {j}", None, None) for i in range(6) for j in range(longest)]
    assert rows(nodes_of(spark.createDataFrame(turns, TURNS))) == brute_nodes([t[:4] for t in turns])


def test_nulls_ties_and_repeated_rows(spark):
    turns = [
        (5, None, None, None, None, None), (5, 1, "x", "", "n", 0), (5, 1, "x", "", "n", 0), (None, 1, "x", "y", "n", 0), (307, 0, "u", "q", "n", 0),
        (-3, 0, "u", "é", "n", 0), (-3, 3, "u", "é", "n", 0), (0, 1, "b", "tie", "n", 0), (0, 1, "a", "tie", "n", 0), (6, 0, "x", "long " * 50_000, "n", 0),
    ]
    assert rows(nodes_of(spark.createDataFrame(turns, TURNS))) == brute_nodes([t[:4] for t in turns])
    assert nodes_of(spark.createDataFrame([], TURNS)).collect() == []


def test_members_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "PIECE_BYTES", 50)
    ends = spark.range(3000).selectExpr("cast(if(id % 3 = 0, 'a', 'b') as binary) as name", "id as conv_id")
    for name, digest in rows(turn_trie.member_digests(ends)):
        ids = ",".join(str(i) for i in range(3000) if (i % 3 == 0) == (name == b"a"))
        assert digest == hashlib.sha256(ids.encode()).hexdigest()
