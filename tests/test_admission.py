"""The limit of chains that a transcript is projected through."""

from genoweave.operators import projections as P


def test_admission_limit(spark):
    rows = [(1, c, "ORTH") for c in range(120, 0, -1)] + [(1, 500, "PARA"), (1, 600, "P_PGENE"), (2, 7, "SPAN"), (2, 8, "SPAN"), (2, 9, "SPAN")]
    df = spark.createDataFrame(rows, "tx long, chain long, class string")
    kept = lambda **limit: {(r["tx"], r["chain"]) for r in P.admit(df, **limit).collect()}
    assert kept() == {(1, c) for c in [*range(1, 101), 600]} | {(2, 7), (2, 8), (2, 9)}
    assert kept(most=1) == {(1, 1), (1, 600), (2, 7)}
