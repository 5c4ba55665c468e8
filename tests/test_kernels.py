"""Rows of the fit of boosted trees, by partition."""

from genoweave.operators import kernels


def test_fit_rows_have_bounded_partitions(spark):
    rows = spark.range(0, 1000, 1, 2)
    cut = kernels.fit_rows(rows, 100)
    sizes = cut.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 1000 and max(sizes) <= 120
    assert kernels.fit_rows(rows, 500).rdd.getNumPartitions() == 2  # small enough: left alone
    assert kernels.fit_rows(rows.limit(0), 100).count() == 0


def test_fit_by_bounded_partitions(spark):
    rows = spark.range(2000).selectExpr("id AS tx", "id % 3 AS chain", "id % 50 AS exon_cover", "id * 7 % 40 AS a", "id * 7 % 40 * 2.5 AS pred")
    whole, cut = (kernels.train_and_score(rows, ["a"], 2, most).orderBy("tx").collect() for most in (10**9, 100))
    assert len(cut) == 2000 and all(abs(x["prob"] - y["prob"]) < 1e-9 for x, y in zip(whole, cut, strict=True))
