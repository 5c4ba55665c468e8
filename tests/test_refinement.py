"""Edge cases of the refinement operators."""

import pytest
from pyspark.sql import functions as F

from genoweave.operators import refinement as R


def test_rescued_ends_take_the_nearest_codon(spark):
    cases = [
        ("ATGATGCCCGGG", 9, "ATG", 3),  # the nearer of two, never position 0
        ("ATGCCCGGG", 6, "ATG", 6),
        ("CATGCCGGGG", 7, "ATG", 1),
        ("CCCATGGGG", 3, "ATG", 3),  # already a start
        ("CCATGCCGGG", 8, "CTG", 8),  # none in the reference
        ("", 0, "ATG", 0),
    ]
    rows = spark.createDataFrame(cases, "q string, s int, r string, want int")
    assert [r[0] for r in rows.select(R.alternative_start(F.col("q"), F.col("s"), F.col("r")) == F.col("want")).collect()] == [True] * len(cases)
    stops = [("CCCGGGCCTAACTAG", 6, "TAA", 15), ("CCCTAA", 6, "TAA", 6), ("CCCNNNTAA", 6, "TGA", 6), ("CCCGGGTAATAA", 6, "CCC", 6), ("CCCGGGTAATAA", 6, "TGA", 9), ("CCCGGG", 6, "TGA", 6)]
    rows = spark.createDataFrame(stops, "q string, s int, r string, want int")
    assert [r[0] for r in rows.select(R.alternative_stop(F.col("q"), F.col("s"), F.col("r")) == F.col("want")).collect()] == [True] * len(stops)


def test_masks_are_taken_back_where_one_mutation_counts(spark):
    schema = "proj string, mut int, class string, exon int, codon int, n_codons int, n_exons int, reason string"
    rows = [("a", 1, "STOP", 1, 95, 100, 2, None), ("a", 2, "FS_DEL", 1, 50, 100, 2, "Compensated"), ("b", 1, "STOP", 1, 95, 100, 2, None), ("b", 2, "STOP", 1, 50, 100, 2, None), ("b", 3, "FS_DEL", 1, 50, 100, 2, "Compensated"), ("b", 4, "STOP", 2, 60, 100, 2, None)]
    exons = spark.createDataFrame([("b", 2, "D")], "proj string, exon int, presence string")
    starts = spark.createDataFrame([], "proj string, codon int")
    got = {(r.proj, r.mut): r.reason for r in R.masked_mutations(spark.createDataFrame(rows, schema), exons, starts).collect()}
    assert got == {("a", 1): "C-terminal", ("a", 2): "Compensated", ("b", 1): None, ("b", 2): None, ("b", 3): None, ("b", 4): "Exon is deleted"}


def test_deleted_intron_masks_both_sites(spark):
    schema = "tx int, exon int, n_exons int, aligned boolean, acceptor string, donor string, ref_acceptor string, ref_donor string, acceptor_u12 boolean, donor_u12 boolean, intron_deleted boolean"
    rows = [(1, 1, 2, True, "aa", "cc", "ag", "gt", False, False, True), (1, 2, 2, True, "tt", "cc", "ag", "gt", False, False, False)]
    got = {(r.exon, r["class"], r.site, r.reason) for r in R.splice_site_mutations(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, "SSMD", "--", "Intron deletion"), (2, "SSMA", "--", "Intron deletion")}


def test_repeated_names_and_reversed_ranges_are_errors(spark):
    schema = "name string, chrom string, cds_start long, cds_end long, blocks array<struct<s: long, e: long>>"
    for rows in ([("t", "c", 0, 3, [(0, 3)])] * 2, [("t", "c", 3, 0, [(0, 3)])]):
        with pytest.raises(Exception, match="twice|before it starts"):
            R.annotation_reasons(spark.createDataFrame(rows, schema)).collect()
