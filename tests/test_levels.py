"""Levelled bins against all pairs, on intervals from one base to billions."""

import random

from pyspark.sql import functions as F

from genoweave.operators import intervals as I


def spans(rng, n):
    out = []
    for _ in range(n):
        size = int(10 ** rng.uniform(0, 10)) if rng.random() < 0.5 else rng.randrange(1, 3000)
        start = rng.randrange(0, 4_000_000_000) if rng.random() < 0.3 else rng.choice([0, 1023, 1024, 32768, 1 << 20]) + rng.randrange(0, 5000)
        out.append((rng.choice(["a", "b"]), start, start + size))
    return [*out, ("a", 5, 5), ("b", 9, 3), ("a", 1024, 2048), ("a", 1024, 2048)]


def test_levelled_join(spark):
    rng = random.Random(6)
    left, right = [(n, *x) for n, x in enumerate(spans(rng, 150))], [(n, *x) for n, x in enumerate(spans(rng, 150))]
    a = spark.createDataFrame(left, "i long, chrom string, s long, e long")
    b = spark.createDataFrame(right, "j long, chrom string, p long, q long")
    want = sorted((i, j) for i, c, s, e in left for j, d, p, q in right if c == d and s < e and p < q and s < q and p < e)
    got = sorted((r["i"], r["j"]) for r in I.levelled_join(a, b, ["chrom"], ("s", "e"), ("p", "q")).collect())
    assert got == want
    assert I.levelled_join(a, b.limit(0), ["chrom"], ("s", "e"), ("p", "q")).collect() == []


def test_rows_of_long_intervals(spark):
    df = spark.range(11).select(F.lit(777).alias("s"), (F.lit(777) + F.pow(F.lit(10), "id").cast("long")).alias("e"))
    for probe in (1, 2):
        rows = I.level_rows(df, "s", "e", 1024, probe).groupBy("e").count()
        assert rows.agg(F.max("count")).first()[0] <= 14


def test_owners(spark):
    rng = random.Random(7)
    data = [(rng.choice("xy"), s, s + rng.choice([0, 3, 40, 50_000]), f"t{rng.randrange(12)}") for s in [rng.randrange(0, 400) for _ in range(60)]]
    got = {tuple(r) for r in I.unit_owners(spark.createDataFrame(data, "chrom string, s long, e long, tx string"), ["chrom"], "s", "e", "tx").collect()}
    want = set()
    for chrom in "xy":
        at = sorted({p for c, s, e, _ in data if c == chrom and e > s for p in (s, e)})
        want |= {(chrom, u, v, t) for u, v in zip(at, at[1:], strict=False) for c, s, e, t in data if c == chrom and s <= u and v <= e and e > s}
    assert got == want
