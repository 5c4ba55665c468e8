"""Pairs by starts that lie in intervals against all pairs, and how many rows meet in vain."""

import random

from pyspark.sql import functions as F

from genoweave.operators import features as T
from genoweave.operators import intervals as I


def test_same_strand_overlaps(spark):
    rng = random.Random(3)
    data = []
    for i in range(250):
        s = rng.choice([0, 63, 64, 65, 4096, 1 << 33]) + rng.randrange(300) * rng.choice([0, 1])
        data.append((i % 240, rng.choice(["a", "b", None]), rng.randrange(2), s, s + rng.choice([0, -4, 1, 63, 64, 65, 900, 70_000])))
    data += [(500, "a", 0, -200, 90), (501, "a", 0, -130, -129), (502, "a", 0, 0, 5_000_000_000)]
    df = spark.createDataFrame(data, "chain long, chrom string, strand int, c_start long, c_end long")
    want = sorted((x[0], y[0]) for x in data for y in data if x[0] < y[0] and x[1] and x[1:3] == y[1:3] and x[3] < y[4] and y[3] < x[4] and x[3] < x[4] and y[3] < y[4])
    assert sorted(map(tuple, T.same_strand_overlaps(df).collect())) == want


def test_rows_that_meet_in_vain(spark):
    """Short intervals on a long sequence: little more rows meet in a bin than lie in an interval."""
    rows = spark.range(4000).select("id", (F.col("id") * 37 % 60_000).alias("s")).withColumn("e", F.col("s") + 100 + F.col("id") % 300).withColumn("c", F.lit("a"))
    met = I.meet_in_bins(rows, rows.select("c", F.col("s").alias("p")), ["c"], ("s", "e"), "p")
    inside = met.filter("s <= p AND p < e").count()
    assert met.count() < 1.7 * inside
