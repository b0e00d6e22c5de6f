"""Dealing groups in pairs of blocks: what must meet does, once."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from wattframe.llm import blocks, graph


@pytest.mark.parametrize("block_rows", [1, 3, 1024])
def test_rows_of_different_components_meet_once(spark, block_rows):
    pick = random.Random(4)
    rows = [(k, n, 1 if pick.random() < 0.8 else n) for k in range(4) for n in range(100 * k, 100 * k + 25)]
    rows += [(9, 900 + n, 900 + n) for n in range(12)] + [(10, 1000, 5)]  # no large component; one row
    frame = spark.createDataFrame(rows, "bucket long, node long, component long")
    cells = defaultdict(list)
    for r in blocks.deal_blocks(frame, "bucket", "node", block_rows).collect():
        cells[r.bucket, r.left, r.right].append((r.node, r.component, r.block))
    met = Counter()
    for (_, left, right), own in cells.items():
        for a, b in combinations(sorted(own), 2):
            if a[1] != b[1] and (left == right or a[2] != b[2]):
                met[a[0], b[0]] += 1
    by_key = defaultdict(list)
    for k, n, c in rows:
        by_key[k].append((n, c))
    expected = {
        (a[0], b[0]) for own in by_key.values() for a, b in combinations(sorted(own), 2) if a[1] != b[1]
    }
    assert met == Counter(expected)
    if block_rows == 3:  # members of a large component come once for each block of the others
        assert sum(map(len, cells.values())) < 25 * 25 * 4


def test_stars_are_confirmed_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 4)
    pick = random.Random(5)
    sets = {n: np.unique([pick.randint(0, 9) for _ in range(8)]).astype(np.uint64) for n in range(40)}
    pairs = [(0, n) for n in range(1, 40)] + [(n, n + 1) for n in range(1, 39)]
    linked = lambda u, v: len(np.intersect1d(u, v)) >= 4
    frame = spark.createDataFrame(pairs, "a long, b long")
    bodies = spark.createDataFrame([(n, s.tobytes()) for n, s in sets.items()], "node long, found binary")
    # a node with two sets: one of them is enough
    more = spark.createDataFrame([(1, sets[0].tobytes())], "node long, found binary")
    got = blocks.confirm_stars(frame, bodies.unionAll(more), linked).collect()
    expected = {
        (a, b)
        for a, b in pairs
        if linked(sets[a], sets[b]) or 1 in (a, b) and linked(sets[0], sets[b if a == 1 else a])
    }
    assert len(got) == len(expected) and {(r.a, r.b) for r in got} == expected


def test_wide_columns_are_joined_when_blocks_are_known(spark):
    rows = [(k, n, n) for k in range(3) for n in range(20)]
    frame = spark.createDataFrame(rows, "bucket long, node long, component long")
    wide = spark.createDataFrame([(n, f"wide {n}") for n in range(20)], "node long, wide string")
    dealt = blocks.deal_blocks(frame, "bucket", "node", 4, more=wide).collect()
    plain = blocks.deal_blocks(frame, "bucket", "node", 4).collect()
    assert {r.wide for r in dealt if r.node == 7} == {"wide 7"}
    names = ("bucket", "left", "right", "block", "node")
    assert Counter(tuple(r[n] for n in names) for r in dealt) == Counter(
        tuple(r[n] for n in names) for r in plain
    )


def test_stars_need_no_second_turn(spark, monkeypatch):
    kept = []
    cut = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda rows: kept.append(cut(rows)) or kept[-1])
    # repeated edges, a loop, and two stars
    edges = [(1, n) for n in range(2, 9)] + [(12, 11), (13, 11), (11, 12), (1, 1), (2, 1)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.components(frame).collect()}
    assert got == {**{n: 1 for n in range(1, 9)}, 11: 11, 12: 11, 13: 11}
    assert len(kept) == 2  # the edges, and the stars


def test_chains_become_stars(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(200, 150), (300, 301)]
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = graph.components(frame).collect()
    got = {r.node: r.component for r in rows}
    expected = {n: 100 for n in [*range(100, 161), 200]} | {300: 300, 301: 300}
    assert got == expected and len(rows) == len(expected)
    assert graph.components(frame.limit(0)).collect() == []
