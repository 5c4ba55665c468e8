"""Biconnected components and articulation points against removal of one vertex after the other."""

import random

import pytest

from genoweave.operators import blocks


def reached(adjacent, start, without):
    seen, todo = {start}, [start]
    while todo:
        for y in adjacent[todo.pop()]:
            if y not in seen and y != without:
                seen.add(y)
                todo.append(y)
    return seen


def adjacency(edges):
    out = {}
    for x, y in edges:
        if x is not None and y is not None and x != y:
            out.setdefault(x, set()).add(y)
            out.setdefault(y, set()).add(x)
    return out


def parts(edges):
    """vertex -> number of parts that its component falls into without it."""
    adjacent, out = adjacency(edges), {}
    for v, near in adjacent.items():
        left, n = set(near), 0
        while left:
            left -= reached(adjacent, next(iter(left)), v)
            n += 1
        out[v] = n
    return out


def same_block(edges):
    """Pairs of edges at a shared vertex that no other vertex's loss tells apart: one block."""
    adjacent, out = adjacency(edges), {}
    plain = {(min(e), max(e)) for e in edges if None not in e and e[0] != e[1]}
    for x, y in plain:
        for v in (x, y):
            side = reached(adjacent, y if v == x else x, v)
            for w in adjacent[v] & side:
                out.setdefault((x, y), set()).add((min(v, w), max(v, w)))
    return out


def graph(seed):
    rng, edges = random.Random(seed), []
    for base in range(0, 200, 20):
        n = rng.randrange(2, 20)
        edges += [(base + rng.randrange(i), base + i) for i in range(1, n)]  # a tree
        edges += [(base + rng.randrange(n), base + rng.randrange(n)) for _ in range(rng.randrange(n))]
    edges += [(1000, 1000 + i) for i in range(1, 150)]  # a hub with more leaves than bins
    edges += [(2000 + i, 2001 + i) for i in range(40)] + [(2000, 2010), (2005, 2020)]  # a path with chords
    return edges + edges[:5] + [(b, a) for a, b in edges[5:9]] + [(7000, 7000), (None, 3), (4, None)]


def test_points_and_blocks(spark, monkeypatch):
    edges = graph(3)
    df = spark.createDataFrame([(*e, "x", 1) for e in edges], "a long, b long, vertex string, root long")
    done = blocks._blocks(df, "a", "b")
    monkeypatch.setattr(blocks, "_blocks", lambda *_: done)
    want = {v: n for v, n in parts(edges).items() if n > 1}
    assert {r["vertex"]: r["n_blocks"] for r in blocks.articulation_points(df).collect()} == want
    block = {(r["a"], r["b"]): r["block"] for r in blocks.biconnected_components(df).collect()}
    beside = same_block(edges)
    assert set(block) == set(beside)
    for e, others in beside.items():
        for o in others:
            assert block[e] == block[o]
    # blocks that share a vertex are told apart by it, so their number at each vertex is that of the parts
    for v, n in parts(edges).items():
        assert len({k for e, k in block.items() if v in e}) == n


def test_chimeras_are_cut_out(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "d"), ("x", "y")], "r string, q string")
    got = {r["vertex"]: (r["chimeric"], r["root"]) for r in blocks.split_chimeras(df, "r", "q").collect()}
    assert got == {"a": (False, "a"), "b": (False, "a"), "c": (True, None), "d": (True, None), "e": (False, "e"), "f": (False, "e"), "x": (False, "x"), "y": (False, "x")}


@pytest.mark.parametrize("rows", [[], [(1, 1), (None, 2)]])
def test_no_edges(spark, rows):
    df = spark.createDataFrame(rows, "a long, b long")
    assert blocks.articulation_points(df).collect() == [] and blocks.biconnected_components(df).collect() == [] and blocks.split_chimeras(df).collect() == []


def regrouped(edges):
    """vertex -> root without the points, None for a point."""
    adjacent = adjacency(edges)
    cut = {v for v, n in parts(edges).items() if n > 1}
    rest = adjacency([e for e in edges if not cut & set(e)])
    return {v: None if v in cut else min(reached(rest, v, None)) if v in rest else v for v in adjacent}


def test_small_components_are_walked_where_they_lie(spark, monkeypatch):
    """No rounds of tours for components that fit a task, whatever the batches that they come in."""
    monkeypatch.setattr(blocks, "euler_tours", None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for seed, name in ((4, int), (5, "v{}".format)):
            edges = [tuple(None if v is None else name(v) for v in e) for e in graph(seed)]
            df = spark.createDataFrame(edges, "a long, b long" if name is int else "a string, b string")
            assert {r["vertex"]: r["n_blocks"] for r in blocks.articulation_points(df).collect()} == {v: n for v, n in parts(edges).items() if n > 1}
            got = {r["vertex"]: (r["chimeric"], r["root"]) for r in blocks.split_chimeras(df).collect()}
            assert got == {v: (root is None, root) for v, root in regrouped(edges).items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_components_take_the_rounds(spark):
    edges = [e for e in graph(6) if None not in e and e[0] < 2100 and not 1000 <= e[0] < 2000]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["vertex"]: r["n_blocks"] for r in blocks.articulation_points(df, small=12).collect()} == {v: n for v, n in parts(edges).items() if n > 1}
    got = {r["vertex"]: (r["chimeric"], r["root"]) for r in blocks.split_chimeras(df, small=12).collect()}
    assert got == {v: (root is None, root) for v, root in regrouped(edges).items()}
