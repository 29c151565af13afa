"""Ranks of hosts are those of the solved linear system, however long the chain of links."""

import numpy as np
import pytest

from playledger.llm import host_graph
from playledger.llm.queries import RULES


def test_ranks_solve_the_linear_system(spark):
    n = 14
    weight = np.zeros((n, n), int)
    for k in range(n - 1):
        weight[k, k + 1] = 2
    weight[0, 3] = weight[5, 1] = 1
    edges = [(f"h{a}", f"h{b}", int(weight[a, b])) for a in range(n) for b in range(n) if weight[a, b]]
    frame = spark.createDataFrame(edges, "src string, dst string, n long")
    seeds = spark.createDataFrame([("h0", 0.75), ("h3", 0.25)], "host string, seed double")
    found = {r["host"]: r["rank"] for r in host_graph.spread(host_graph._shares(frame, "src", "dst"), seeds).collect()}
    seed = np.zeros(n)
    seed[[0, 3]] = 0.75, 0.25
    share = weight / np.maximum(1, weight.sum(1, keepdims=True))
    wanted = np.linalg.solve(np.eye(n) - 0.85 * share.T, 0.15 * seed)
    assert [found.get(f"h{k}", 0.0) for k in range(n)] == pytest.approx(wanted.tolist(), abs=2 * host_graph.TOLERANCE)


def test_hosts_far_from_a_blocked_one_are_blocked(spark):
    pages = [(0, "http://h0.com/de/1", None)] + [(k, f"http://h{k}.net/a", f'<a href="http://h{k - 1}.{"com" if k == 1 else "net"}/x">') for k in range(1, 12)]
    pages += [(20, "http://good.org/a", None)]
    found = host_graph.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES)
    verdicts = {r.page_id: r.verdict for r in found.collect()}
    assert [verdicts[k] for k in range(12)] == ["block"] * 12 and verdicts[20] == "allow"
