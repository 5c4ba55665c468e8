"""Gene trees against plain nested lists."""

import random

import pytest

from genoweave.operators import trees as t


def text(node):
    if isinstance(node, str):
        return f"{node}:0.1"
    kids, support = node
    return f"({','.join(map(text, kids))}){'' if support is None else support}:1"


def label(node):
    """By rules instead of a table: what the leaves below say, children of children first."""
    if isinstance(node, str):
        return "R" if node.startswith("#R#") else "Q"
    a, b = map(label, node[0])
    if "D" in (a, b) or "P" in (a, b):
        return "D"
    if (a, b) == ("S", "S"):
        return "S"
    if "S" in (a, b):
        return "P"
    if {a, b} == {"R", "Q"}:
        return "S"
    side = {a, b} & {"R", "Dr"}, {a, b} & {"Q", "Dq"}
    return "D" if all(side) else "Dr" if side[0] else "Dq"


def leaves(node):
    return [node] if isinstance(node, str) else [x for k in node[0] for x in leaves(k)]


def nodes(node):
    return [node] if isinstance(node, str) else [node, *(x for k in node[0] for x in nodes(k))]


def pairs(root, least):
    weak = lambda n: not isinstance(n, str) and n[1] is not None and n[1] < least
    every = nodes(root)
    if len(leaves(root)) == 4 and sum(label(n) == "S" for n in every) == 3 and any(map(weak, every)):
        return []
    out = []

    def walk(node, path):
        if isinstance(node, str):
            return
        if len(path) and label(node) == "S" and all(isinstance(k, str) for k in node[0]):
            if not any(label(n) == "P" or weak(n) for n in [*path[1:], node]):
                out.append(tuple(sorted(node[0], key=lambda n: not n.startswith("#R#"))))
        for k in node[0]:
            walk(k, [*path, node])

    walk(root, [])
    name = lambda q: q.rsplit("#", 1)[0]
    return [p for p in out if sum(name(x[1]) == name(p[1]) for x in out) == 1]


def grow(rng, names):
    if len(names) == 1:
        return names[0]
    cut = rng.randrange(1, len(names))
    return ([grow(rng, names[:cut]), grow(rng, names[cut:])], rng.choice([None, 95, 80, 40]))


@pytest.fixture(scope="module")
def cases():
    rng, out = random.Random(2), {}
    for i in range(400):
        n = rng.choice([2, 3, 4, 4, 4, 6, 9])
        names = [f"{rng.choice(['#R#', ''])}t{j if rng.random() < 0.8 else 0}#{j}" for j in range(n)]
        out[i] = grow(rng, names)
    return out


def test_labels_and_pairs(spark, cases):
    df = spark.createDataFrame([(i, text(c) + ";", "x") for i, c in cases.items()], "tree long, newick string, node string")
    labels = {}
    for r in t.label_nodes(df, "tree").orderBy("tree", "node").collect():
        labels.setdefault(r["tree"], []).append(r["label"])
    assert {i: sorted(map(label, nodes(c))) for i, c in cases.items()} == {i: sorted(x) for i, x in labels.items()}
    assert {x for v in labels.values() for x in v} == set(t.KINDS)
    got = {}
    for r in t.tree_pairs(df, "tree", 90).collect():
        got.setdefault(r["tree"], set()).add((r["reference"], r["query"]))
    want = {i: set(pairs(c, 90)) for i, c in cases.items()}
    assert got == {i: x for i, x in want.items() if x} and len(got) > 20


def test_forms_of_newick(spark):
    rows = [(1, "((#R#a:1,b:2)95:1,('#R#c d':1,e:1)[90]:1);"), (2, None), (3, ""), (4, "leaf;"), (5, "((#R#a,b)x,(#R#c,d),(#R#e,f)y);")]
    got = {}
    for r in t.label_nodes(spark.createDataFrame(rows, "tree long, newick string"), "tree").collect():
        got.setdefault(r["tree"], []).append((r["name"], r["support"], r["label"]))
    assert ("#R#c d", None, "R") in got[1] and [s for _, s, _ in got[1] if s] == [95.0, 90.0]
    assert len(got[2]) == len(got[3]) == len(got[4]) == 1 and got[5][0][2] == "S"


def test_cliques_and_settled_pairs(spark):
    edges = spark.createDataFrame([("r1", "q1"), ("r1", "q2"), ("r2", "q2"), ("r3", "q3"), ("r3", "q3")], "r string, q string")
    starts = spark.createDataFrame([("r1",), ("r2",), ("r1",), ("r9",)], "gene string")
    assert sorted(map(tuple, t.restored_cliques(edges, starts).collect())) == [("q1", "q1"), ("q1", "q2"), ("q1", "r1"), ("q1", "r2")]
    known = spark.createDataFrame([("r1", "q1"), ("r9", "q9"), ("r2", "q1")], "reference string, query string")
    assert sorted(map(tuple, t.settle_pairs(edges, known).collect())) == [("r1", "q1", True), ("r2", "q2", False), ("r3", "q3", False)]
