"""Query genes from overlapping projections, and training rows for the chain classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators import local
from genoweave.operators.graph import connected_components
from genoweave.operators.intervals import RANGE, carried, interval_join, island_rows


def overlapping_pairs(exons: DataFrame, key: str, on: list[str]) -> DataFrame:
    """exons (key, on..., e_start, e_end) -> (a, b), a < b: keys with an overlap of any exon, each once."""
    side = lambda x: exons.select(*on, F.col(key).alias(x), F.col("e_start").alias(f"{x}_s"), F.col("e_end").alias(f"{x}_e"))
    hits = interval_join(side("a"), side("b"), on, ("a_s", "a_e"), ("b_s", "b_e"))
    return hits.filter("a < b").select("a", "b").distinct()


def projection_links(exons: DataFrame, apart: DataFrame) -> DataFrame:
    """(a, b): links that join the projections into the components of ``query_gene_loci``.

    Overlapping exons of one transcript's projections on a strand are an island, and its members are tied to the smallest one.
    Islands of different transcripts meet in tasks, which hand on ties instead of pairs, so what is
    moved grows with the exons. The transcripts that its own is apart from are in an island's row.
    """
    on = ["chrom", "strand"]
    rows = exons.filter("e_end > e_start AND proj IS NOT NULL AND chrom IS NOT NULL AND strand IS NOT NULL").select("proj", "tx", *on, "e_start", "e_end")
    rows = island_rows(rows, [*on, "tx"], "e_start", "e_end", ["proj"]).withColumnRenamed("grp", "_bin")
    islands = rows.groupBy(*on, "tx", "_bin").agg(F.min("proj").alias("a"), F.min("e_start").alias("a_s"), F.max("e_end").alias("a_e"))
    members = carried(rows, [*on, "tx"], islands).select("a", F.col("proj").alias("b"))
    both = apart.select(F.explode(F.array(F.struct(F.col("a").alias("tx"), F.col("b").alias("o")), F.struct(F.col("b").alias("tx"), F.col("a").alias("o")))).alias("p"))
    lists = both.groupBy("p.tx").agg(F.collect_set("p.o").alias("apart"))
    left = islands.join(lists, "tx", "left").select(*on, "a", "a_s", "a_e", "apart")
    right = islands.select(*on, F.col("a").alias("b"), F.col("tx").alias("tx_b"), F.col("a_s").alias("b_s"), F.col("a_e").alias("b_e"))
    ties = local.local_overlaps(left, right, on, ["a", "a_s"], ("a_s", "a_e"), ("b_s", "b_e"), local.ties, local.typed(left, "a") + ", " + local.typed(right, "b"))
    return members.unionByName(ties)


def query_gene_loci(exons: DataFrame, apart: DataFrame) -> DataFrame:
    """exons (proj, tx, chrom, strand, e_start, e_end), apart (a, b) -> (chrom, locus, g_start, g_end, n).

    Projections with an exon overlap on one strand form a query gene, but a pair whose reference
    transcripts are in ``apart`` (a < b, those of overlapping reference genes) is no link. A gene is
    a component of the links; its loci are numbered along each chromosome by start, end and smallest
    projection. Projections without a link are genes of their own. A projection has one transcript.
    """
    roots = connected_components(projection_links(exons, apart)).select(F.col("vertex").alias("proj"), "root")
    spans = exons.groupBy("proj", "chrom").agg(F.min("e_start").alias("s"), F.max("e_end").alias("e"))
    genes = spans.join(roots, "proj", "left").groupBy("chrom", F.coalesce("root", "proj").alias("root")).agg(F.min("s").alias("g_start"), F.max("e").alias("g_end"), F.count("*").alias("n"))
    # ranges of a chromosome are numbered apart and take over how many loci come before them
    ranged = genes.withColumn("_bin", F.floor(F.col("g_start") / RANGE))
    earlier = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("chrom", "_bin").agg(F.count("*").alias("_n")).select("chrom", "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    number = F.row_number().over(Window.partitionBy("chrom", "_bin").orderBy("g_start", "g_end", "root"))
    return carried(ranged, ["chrom"], before).select("chrom", (F.col("_base") + number).cast("int").alias("locus"), "g_start", "g_end", "n")


def training_rows(features: DataFrame, genes: DataFrame, one2one: DataFrame, least_cover: int = 10, most_chains: int = 10) -> DataFrame:
    """(gene, tx, chain, y): rows to fit the chain classifier on.

    features (tx, chain, exon_cover, ex_fract, pred), genes (gene, tx), one2one (gene). A gene counts
    through the isoform of the longest coding sequence (the smallest name on ties). Its best chain
    (the lowest id on ties) is a positive if it covers more than ``least_cover`` bases and at most
    ``most_chains`` chains reach the transcript; all its other chains are negatives.
    """
    rows = features.join(genes.join(one2one.select("gene").distinct(), "gene", "left_semi"), "tx")
    pick = rows.groupBy("gene").agg(F.min_by("tx", F.struct(-F.col("ex_fract"), F.col("tx"))).alias("tx"))
    rows = rows.join(pick, ["gene", "tx"])
    own = Window.partitionBy("gene", "tx")
    best = F.row_number().over(own.orderBy(F.desc("pred"), "chain")) == 1
    rows = rows.withColumns({"best": best, "chains": F.count("*").over(own)})
    fit = (F.col("exon_cover") > least_cover) & (F.col("chains") <= most_chains)
    return rows.filter(~F.col("best") | fit).select("gene", "tx", "chain", F.col("best").cast("int").alias("y"))
