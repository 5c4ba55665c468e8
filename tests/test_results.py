"""Hand-made cases of the result tables, subchains, fragment gates and the session's shared folder."""

import itertools

import pytest

from genoweave import session
from genoweave.operators import chains as C
from genoweave.operators import kernels as K
from genoweave.operators import results as R


def rows(df):
    return {tuple(r) for r in df.collect()}


ALIGNED = "chain long, chrom string, b_start long, b_end long, q_start long, q_end long, codirected boolean"


def test_subchains_and_boundaries_on_both_strands(spark):
    blocks = spark.createDataFrame([(1, "c", 100, 200, 1000, 1100, True), (1, "c", 250, 300, 1160, 1210, True), (2, "c", 100, 200, 900, 1000, False), (2, "c", 250, 300, 800, 850, False)], ALIGNED)
    region = spark.createDataFrame([("t", "c", 150, 280)], "tx string, chrom string, k_start long, k_end long")
    assert rows(C.subchains(region, blocks)) == {
        ("t", 1, 1, 150, 200, 1050, 1100, 50, 60), ("t", 1, 2, 250, 280, 1160, 1190, None, None),
        ("t", 2, 1, 150, 200, 900, 950, 50, 50), ("t", 2, 2, 250, 280, 820, 850, None, None),
    }
    exons = spark.createDataFrame([("t", "c", 90, 120), ("t", "c", 260, 400), ("t", "d", 0, 500)], "tx string, chrom string, e_start long, e_end long")
    assert rows(C.cds_boundaries(exons, blocks)) == {("t", 1, 100, 300, 1000, 1210), ("t", 2, 100, 300, 800, 1000)}
    assert C.subchains(region.limit(0), blocks).count() == 0


def test_gates_of_tiling(spark):
    cover = spark.createDataFrame([("a", 1, 2), ("a", 2, 2), ("b", 1, 4), ("b", 2, 1), ("c", 1, 2), ("d", 1, 3), ("d", 2, 3)], "tx string, chain long, n_exons long")
    sizes = spark.createDataFrame([(t, 4) for t in "abcd"], "tx string, n long")
    assert rows(C.tiling_candidates(cover, sizes)) == {("a", 1), ("a", 2)}


def test_tiling_equals_brute_force(spark):
    spans = [(i, (i * 977) % 3000, (i * 977) % 3000 + 300 + i * 131 % 500, 10 + i * 7 % 13) for i in range(11)]
    chained = lambda p: all(a[2] - b[1] <= K.OVERLAP for a, b in itertools.pairwise(p))
    ordered = sorted(spans, key=lambda s: (s[2], s[1], s[0]))
    best = max(sum(s[3] for s in p) for n in range(1, 12) for p in itertools.combinations(ordered, n) if chained(p))
    df = spark.createDataFrame([("t", *s) for s in spans], "tx string, chain long, c_start long, c_end long, score long")
    got = [r["chain"] for r in K.best_tiling(df).orderBy("step").collect()]
    assert sum(s[3] for s in spans if s[0] in got) == best and chained([spans[i] for i in got])


def test_dubious_orthologs(spark):
    p = [("t#1", 90, "ORTH", "I", 0, 90), ("t#2", 80, "ORTH", "N", 30, 90), ("t#3", 80, "ORTH", None, 0, 10), ("t#4", 80, "ORTH", "L", 30, 10), ("t#5", 80, "PARA", "N", 30, 10), ("t#6,7", 80, "ORTH", "N", 30, 10), ("t#8", 90, "ORTH", "N", 30, 10)]
    df = spark.createDataFrame([("t", *x) for x in p], "tx string, proj string, prob long, class string, status string, exon_qlen long, intron_cover long")
    assert rows(R.dubious_orthologs(df, 20, 40)) == {("t", "t#2"), ("t", "t#3")}
    assert rows(R.dubious_orthologs(df, 20, 40, against_top=True)) == {("t", "t#2"), ("t", "t#3"), ("t", "t#4")}


def test_names_of_query_genes(spark):
    t = [("A", "q1", 5, "one2many"), ("A", "q2", 6, "one2many"), ("B", "q3", 7, "many2one"), ("C", "q3", 3, "many2one"), ("D", "q4", 1, "one2one"), *[(r, "q5", i, "many2one") for i, r in enumerate("WXYZ")], ("E", None, None, "one2zero")]
    df = spark.createDataFrame(t, "r string, q string, chain long, class string")
    assert rows(R.orthology_names(df)) == {("q1", "A_a"), ("q2", "A_b"), ("q3", "C,B"), ("q4", "D"), ("q5", "W+")}


def test_record_ends_where_the_last_projection_ends(spark):
    p = [("t", 1, "c", "+", 0, 100), ("t", 2, "c", "+", 50, 60), ("t", 3, "c", "+", 100, 120), ("t", 4, "c", "-", 10, 20)]
    df = spark.createDataFrame(p, "tx string, chain long, chrom string, strand string, q_start long, q_end long")
    assert rows(R.pseudogene_track(df)) == {("c", 0, 60, "t#1,2", "+"), ("c", 100, 120, "t#3", "+"), ("c", 10, 20, "t#4", "-")}


def test_missing_partner_is_an_error(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(1, "a")], "k long, v string")
    assert rows(R.complete_join(left.filter("k = 1"), right, ["k"], "score")) == {(1, "a")}
    with pytest.raises(Exception, match="no score for 2"):
        R.complete_join(left, right, ["k"], "score").collect()


def test_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_exons_are_mapped_through_blocks_and_gaps(spark):
    forward = [(1, "c", 1, 100, 200, 1000, 1100, True), (1, "c", 2, 300, 400, 1250, 1350, True), (1, "c", 3, 9000, 9100, 1360, 1460, True)]
    back = [(2, "c", b, s, e, 5000 - qe, 5000 - qs, False) for _, _, b, s, e, qs, qe, _ in forward]
    blocks = spark.createDataFrame(forward + back, "chain long, chrom string, blk long, b_start long, b_end long, q_start long, q_end long, codirected boolean")
    exons = spark.createDataFrame([("t", "c", 1, 150, 190), ("t", "c", 2, 190, 310), ("t", "c", 3, 220, 280), ("t", "c", 4, 500, 600), ("t", "c", 5, 10_000, 10_050), ("t", "c", 6, 90, 110)], "tx string, chrom string, exon long, e_start long, e_end long")
    want = {(1, "mapped", 1050, 1090, 40), (2, "mapped", 1090, 1260, 20), (3, "gap", 1100, 1250, 0), (4, "missing", None, None, 0), (5, "out", None, None, 0), (6, "mapped", 990, 1010, 10)}
    pairs = spark.createDataFrame([("t", 1), ("t", 2)], "tx string, chain long")
    got = C.map_exons(exons, pairs, blocks)
    assert rows(got.filter("chain = 1").drop("tx", "chain")) == want
    assert rows(got.filter("chain = 2").drop("tx", "chain")) == {(x, s, a and 5000 - b, b and 5000 - a, n) for x, s, a, b, n in want}
    assert C.map_exons(exons, pairs.limit(0), blocks).count() == 0
