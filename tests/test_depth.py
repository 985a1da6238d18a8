"""Junction paths of the registered queries against a search by hand, to the full depth."""

import os

import pytest

from roadloom.config import Graph
from roadloom.plans import registry
from roadloom.plans import views as V

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def brute_paths(edges, depth):
    after = {}
    for a in edges:
        after[a.segment_id] = [b for b in edges if a.v == b.u and a.u != b.v]
    found = []

    def walk(src, path, at):
        for b in after[at]:
            if b.segment_id == src or b.segment_id in path:
                continue
            if not b.is_junction:
                if path:
                    found.append((src, tuple(path), b.segment_id))
            elif len(path) < depth:
                walk(src, [*path, b.segment_id], b.segment_id)

    for a in edges:
        if not a.is_junction:
            walk(a.segment_id, [], a.segment_id)
    return found


def test_junction_queries_go_to_the_configured_depth(spark):
    edges = V.edges(spark, SF).collect()
    want = brute_paths(edges, Graph().depth)
    assert max(len(p) for _, p, _ in want) > 4
    got = [(x.src, tuple(x.path.split(">")), x.dst) for x in registry.QUERIES["junction_chain_paths"](spark, SF).collect()]
    assert sorted(got) == sorted(want)
    ends = {(x.src, x.dst): x.n for x in registry.QUERIES["junction_bypass"](spark, SF).collect()}
    least = {}
    for s, p, e in want:
        least[s, e] = min(len(p), least.get((s, e), 99))
    assert ends == least
    bad = {(s, e, p[0]) for s, p, e in want if len(p) >= 2 and int(s) % 3 == 0}
    left = [(s, p, e) for s, p, e in want if not any((s, e, x) in bad for x in p)]
    got = [(x.src, tuple(x.path.split(">")), x.dst) for x in registry.QUERIES["restricted_paths"](spark, SF).collect()]
    assert sorted(got) == sorted(left)
    node = {e.segment_id: e.v for e in edges}
    foot = {(e.segment_id, e.v) for e in edges if not e.is_junction} | {(s, node[x]) for s, p, _ in want for x in p}
    assert {(x.segment_id, x.node) for x in registry.QUERIES["junction_footprints"](spark, SF).collect()} == foot


