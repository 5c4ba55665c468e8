"""Links of query genes against all pairs, and their number."""

import random

from pyspark.sql import functions as F

from genoweave.operators import loci as L


def test_links_of_all_pairs(spark):
    rng = random.Random(5)
    exons = []
    for p in range(160):
        for _ in range(rng.choice([1, 1, 2])):
            s = rng.randrange(9000)
            exons.append((p, f"t{p % 7}" if p % 31 else None, rng.choice(["x", "y"]) if p % 37 else None, p % 2, s, s + rng.choice([0, 5, 60, 300])))
    apart = [("t0", "t1"), ("t1", "t2"), ("t2", "t5"), ("t3", "t6"), ("t4", "t9")]
    tx = {p: t for p, t, *_ in exons}
    group = {p: p for p in tx}

    def find(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, _, c, x, s, e in exons:
        for b, _, d, y, u, v in exons:
            if a < b and c and (c, x) == (d, y) and s < v and u < e and s < e and u < v and tuple(sorted((str(tx[a]), str(tx[b])))) not in apart:
                p, q = sorted((find(a), find(b)))
                group[q] = p
    df = spark.createDataFrame(exons, "proj long, tx string, chrom string, strand int, e_start long, e_end long")
    got = L.connected_components(L.projection_links(df, spark.createDataFrame(apart, "a string, b string"))).collect()
    assert {r["vertex"]: r["root"] for r in got} == {p: find(p) for p in tx if any(find(q) == find(p) for q in tx if q != p)}


def test_number_of_links(spark):
    """1,200 projections at one place have 719,400 pairs; what leaves the tasks are a few links each."""
    rows = spark.range(1200).select(F.col("id").alias("proj"), (F.col("id") % 40).alias("tx"), F.lit("x").alias("chrom"), F.lit(1).alias("strand"), F.col("id").alias("e_start"), (F.col("id") + 5000).alias("e_end"))
    links = L.projection_links(rows, spark.createDataFrame([(0, 1)], "a long, b long"))
    assert links.count() < 4 * 1200 and {r["root"] for r in L.connected_components(links).collect()} == {0}
