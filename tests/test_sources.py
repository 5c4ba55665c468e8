"""Small files of every format, read, and written and read again."""

import pytest
from pyspark.sql import functions as F

from genoweave.operators import annotation as A
from genoweave.operators import loci as L
from genoweave.sources import genomic as N


@pytest.fixture
def put(tmp_path):
    def write(text):
        path = tmp_path / "in.txt"
        path.write_text(text)
        return str(path)

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bed12(spark, put):
    df = N.read_bed12(spark, put("# note\nc1\t100\t200\tt#1\t0\t-\t110\t190\t0,0,0\t2\t10,20,\t0,80,\n"))
    assert [(b["s"], b["e"]) for b in df.first()["blocks"]] == [(100, 110), (180, 200)]
    assert rows(N.bed12_lines(df)) == [("c1\t100\t200\tt#1\t0\t-\t110\t190\t0,0,0\t2\t10,20\t0,80",)]


def test_chains_on_both_strands(spark, put):
    text = "##matrix\nchain 9 c1 1000 + 10 30 q 500 - 100 125 7\n5 5 10\n10\n\nchain 8 c1 1000 + 0 4 q 500 + 3 7 8\n4\n"
    chains = N.read_chains(spark, put(text))
    assert {(r["chain"], r["q_start"], r["q_end"]) for r in chains.collect()} == {(7, 375, 400), (8, 3, 7)}
    got = {(r["chain"], r["b_start"], r["b_end"], r["q_from"], r["q_to"]) for r in N.aligned_blocks(chains).collect()}
    assert got == {(7, 10, 15, 395, 400), (7, 20, 30, 375, 385), (8, 0, 4, 3, 7)}
    assert rows(N.chain_lines(chains.filter("chain = 7"))) == [("chain 9 c1 1000 + 10 30 q 500 - 100 125 7\n5\t5\t10\n10\n",)]


def test_swapped_chains(spark, put):
    chains = N.read_chains(spark, put("chain 9 c1 1000 + 10 30 q 500 - 100 125 7\n5 5 10\n10\n\nchain 8 c1 9 + 0 4 q 8 + 3 7 8\n4\n"))
    got = {(r["chain"], r["chrom"], r["b_start"], r["b_end"], r["q_from"], r["q_to"]) for r in N.aligned_blocks(N.swap_chains(chains)).collect()}
    assert got == {(7, "q", 375, 385, 20, 30), (7, "q", 395, 400, 10, 15), (8, "q", 3, 7, 0, 4)}
    assert sorted(rows(N.chain_lines(N.swap_chains(N.swap_chains(chains))))) == sorted(rows(N.chain_lines(chains)))


def test_fasta_tiles_and_fetch(spark, put):
    contigs = N.read_fasta(spark, put(">a one\nACG\nTTT\n>b\n>c\nGG"))
    assert rows(contigs) == [("a one", "ACGTTT"), ("b", ""), ("c", "GG")]
    genome = N.tiles(contigs, 4)
    regions = spark.createDataFrame([(1, "a one", 2, 6), (2, "a one", 5, 99), (3, "b", 0, 1), (4, "c", 2, 2)], "id long, chrom string, start long, end long")
    assert sorted(rows(N.fetch(regions, genome, 4))) == [(1, "GTTT"), (2, "T")]


def test_small_tables(spark, put):
    assert sorted(rows(N.read_isoforms(spark, put("g\tt1\n\tt2\ng\tt1\n")))) == [("g", "t1"), ("t2", "t2")]
    assert rows(N.read_scores(spark, put("a\t5\nb\tx\n"))) == [("a", 5), ("b", 0)]
    got = N.read_introns(spark, put("c\t1\t9\tintron1_U12_GC-AG\t0\t+\nc\t1\t9\tintron2_U2_gc-ag\t0\t+\n")).select("kind", "donor", "regular")
    assert rows(got) == [("U12", "gc", False), ("U2", "gc", True)]


def test_tables_are_written_compressed(spark, tmp_path):
    N.write_table(spark.createDataFrame([(1, "x")], "a long, b string"), str(tmp_path / "t"), "gzip")
    assert rows(spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t"))) == [("1", "x")]
    assert list((tmp_path / "t").glob("*.csv.gz"))


def test_codon_metrics(spark):
    df = spark.createDataFrame([(1, "IIIDILMIIA"), (2, ""), (3, None), (4, "MMM")], "id long, s string")
    got = {r[0]: tuple(r)[1:] for r in A.codon_metrics(df, "id", "s").collect()}
    assert got[1] == (400, 400, 777, False, False) and got[2] == got[3] == (0, 0, 1000, True, True) and got[4][2] == 1000


def test_mutations(spark):
    df = spark.createDataFrame([("t", "ATGGCCTAA", "ATC---TGG"), ("u", "ATGGCC", "ATGG-C"), ("v", None, None), ("w", "ATGGCC", "ATGTAA")], "id string, ref string, query string")
    got = {(r["id"], r["codon"], r["kind"]) for r in A.codon_mutations(df, "id").collect()}
    assert got == {("t", 1, "START_LOSS"), ("t", 2, "DELETED"), ("t", 3, "STOP_LOSS"), ("u", 2, "FRAMESHIFT"), ("w", 2, "NONSENSE")}


def test_frame_runs(spark):
    df = spark.createDataFrame([("t", 1, 1), ("t", 2, 3), ("t", 4, 2), ("t", 5, -1)], "tx string, at long, shift long")
    got = {(r["first"], r["last"], r["compensated"]) for r in A.frame_runs(df, ["tx"], ["at"], "shift").collect()}
    assert got == {(1, 4, True), (5, 5, False)}


def test_projection_names(spark):
    tx, chains, retro = A.split_projection(F.col("p"))
    got = rows(spark.createDataFrame([("a#b#1,2#retro",), ("x#9",)], "p string").select(tx, chains, retro))
    assert got == [("a#b", ["1", "2"], True), ("x", ["9"], False)]


def test_query_gene_loci(spark):
    exons = [(1, 11, "c", "+", 0, 10), (2, 12, "c", "+", 5, 20), (3, 13, "c", "+", 15, 30), (4, 14, "c", "-", 0, 10), (5, 15, "d", "+", 0, 9)]
    df = spark.createDataFrame(exons, "proj long, tx long, chrom string, strand string, e_start long, e_end long")
    apart = spark.createDataFrame([(12, 13)], "a long, b long")
    got = sorted(rows(L.query_gene_loci(df, apart)))
    assert got == [("c", 1, 0, 10, 1), ("c", 2, 0, 20, 2), ("c", 3, 15, 30, 1), ("d", 1, 0, 9, 1)]
    assert L.query_gene_loci(df.limit(0), apart).count() == 0
