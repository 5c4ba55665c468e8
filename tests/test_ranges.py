"""Ranges of a sequence against one sweep over it, and the length of sequence functions."""

import random

import pytest
from pyspark.sql import functions as F

from genoweave.functions import sequence as S
from genoweave.operators import intervals as I
from genoweave.operators import features as T


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_islands_and_units(spark, size):
    r = random.Random(size)
    rows = [(r.choice(["c", "d", None]), s, s + r.randrange(1, 40), i) for i in range(400) for s in [r.randrange(3000)]]
    df = spark.createDataFrame(rows, "chrom string, s long, e long, id long")
    want, units = [], []
    for chrom in ("c", "d", None):
        own = sorted((s, e) for c, s, e, _ in rows if c == chrom)
        grp, m_start, m_end, n = 0, None, -1, 0
        for s, e in own:
            if s < m_end:
                m_end, n = max(m_end, e), n + 1
            else:
                if grp:
                    want.append((chrom, grp, m_start, m_end, n))
                grp, m_start, m_end, n = grp + 1, s, e, 1
        want.append((chrom, grp, m_start, m_end, n))
        cuts = sorted({x for se in own for x in se})
        units += [(chrom, a, b, k) for a, b in zip(cuts, cuts[1:], strict=False) if (k := sum(s <= a < e for s, e in own))]
    got = I.merge_intervals(df, ["chrom"], "s", "e", ["id"], size).select("chrom", "grp", "m_start", "m_end", "n").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    got = I.discretize(df, ["chrom"], "s", "e", size).select("chrom", "u_start", "u_end", "depth").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, units))


def test_long_sequences(spark):
    df = spark.range(1).select(F.repeat(F.lit("ATGGCATAA"), 200_000).alias("s"))
    row = df.select(F.size(S.chunks(F.col("s"), 3)).alias("n"), F.length(S.translate(F.col("s"))).alias("aa"), S.until_stop(F.col("s")).alias("u")).first()
    assert row["n"] == row["aa"] == 600_000 and row["u"] == "ATGGCATAA"


def test_affected_exons_of_ranges(spark):
    m = spark.createDataFrame([(1, "2_4", "X", None), (1, "3", "X", "r"), (1, "9", "safe", None), (2, "1", "X", "safe"), (3, "1", None, None)], "tx long, exon string, class string, reason string")
    n = spark.createDataFrame([(1, 12), (2, 3), (3, 3), (4, 5)], "tx long, n int")
    got = {r["tx"]: (r["affected"], r["percent"]) for r in T.affected_exons(m, n, ["safe"], ["safe"]).collect()}
    assert got == {1: (3, 25.0), 2: (0, 0.0), 3: (1, 33.33), 4: (0, 0.0)}
