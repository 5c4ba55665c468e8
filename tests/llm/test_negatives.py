"""Hard negatives against inner products of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave.llm import negatives as h

SCHEMA = "vec_id long, embedding array<double>, label int, rid string, dim string, vec string, anchor string, segment string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "d", "v", "a", "s", "c") for r in rows], SCHEMA)


def plain(rows, noise=None):
    known = []
    for i, x, label in rows:
        if label is None or x is None or any(c is None or not np.isfinite(c) or not np.isfinite(c * 256) for c in x):
            continue
        if noise and i is not None and i % noise == 0:
            label = (label + 1) % 10
        known.append((i, label, [int(np.floor(256 * c)) for c in x]))
    out = []
    first = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:5]
    for a, (i, label, q) in enumerate(known):
        if i is None or i % 100:
            continue
        scored = [(max(-h.MOST, min(h.MOST, sum(u * v for u, v in zip(q, x, strict=True)))), j, lab) for b, (j, lab, x) in enumerate(known) if b != a and len(x) == len(q)]
        for p, pid, _ in first([s for s in scored if s[2] == label]):
            found = first([s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p])
            out += [(i, pid, r, j, p, s) for r, (s, j, _) in enumerate(found, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clustered(rng, n, dim, spread):
    centres = rng.normal(size=(12, dim)) * 2
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * spread
    return [(int(i), v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]


@pytest.mark.parametrize(("segment", "spread"), [(8, 0.05), (50, 1.0)])
def test_equals_brute_force(spark, monkeypatch, segment, spread):
    monkeypatch.setattr(h, "SEGMENT", segment)
    rows = clustered(np.random.default_rng(segment), 600, 6, spread)
    assert got(h.mine_hard_negatives(frame(spark, rows), noise=7)) == plain(rows, 7) != []


def test_far_segments_are_not_asked_for(spark, monkeypatch):
    monkeypatch.setattr(h, "SEGMENT", 16)
    rows = h.vector_rows(frame(spark, clustered(np.random.default_rng(1), 3000, 6, 0.02)))
    pivots, most = h.fit_pivots(rows)
    index = h.index_vectors(rows, pivots, most)
    sizes = [r["count"] for r in index.groupBy("segment").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 16
    of_pivot = index.groupBy("dim", "pivot", "segment").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"))
    of_pivot = of_pivot.groupBy("dim", "pivot").agg(F.collect_list(F.struct("segment", "lo", "hi")).alias("segments"))
    anchors = rows.filter("vec_id % 100 = 0").selectExpr("rid AS anchor", "dim", "vec")
    distances = h.pivot_distances(anchors, pivots, most)
    turn = anchors.selectExpr("anchor", f"{most**0.5 * 0.2} AS wide", "-1D AS done")
    asked = h.asked_segments(turn, distances, of_pivot).groupBy("anchor").count().collect()
    assert len(asked) <= 30 and np.mean([r["count"] for r in asked]) < 0.5 * len(sizes)


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(h, "SEGMENT", 7)
    copies = [(i, [0.5, 0.25], i % 3) for i in range(0, 400, 4)]
    odd = [
        (None, [0.5, 0.25], 1), (1, None, 1), (2, [], 0), (200, [], 1), (3, [], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (9, [None, 1.0], 1),
        (10, [0.5, 0.2], None), (100, [0.45, 0.25], 1), (100, [0.5, 0.25], 1), (11, [1.0, 2.0, 3.0], 1), (300, [1.0, 2.0, 3.0], 2), (13, [0.9, 2.0, 3.0], 1), (15, [1.1, 2.0, 3.0], 2),
        (17, [1e308, 1.0], 1), (500, [-0.5, 0.1], 1),
    ]
    rows = copies + odd + copies[:20]
    assert got(h.mine_hard_negatives(frame(spark, rows))) == plain(rows) != []


def test_scores_beyond_double_precision(spark):
    rng = np.random.default_rng(3)
    rows = [(i * 50, (rng.normal(size=5) * 2.0**scale).tolist(), i % 2) for i, scale in enumerate([20, 25, 30, 18] * 12)]
    assert got(h.mine_hard_negatives(frame(spark, rows))) == plain(rows)


def test_no_anchor(spark):
    assert h.mine_hard_negatives(frame(spark, [])).collect() == []
    assert h.mine_hard_negatives(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])).collect() == []
