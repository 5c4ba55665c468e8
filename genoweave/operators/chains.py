"""Genome-alignment chains: blocks, gaps, coverage features and liftover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators import local
from genoweave.operators.intervals import interval_join, merge_intervals, overlap

E_RANGE, B_RANGE = ("e_start", "e_end"), ("b_start", "b_end")


def chain_blocks(steps: DataFrame) -> DataFrame:
    """steps (chain, chrom, blk, t_start, size, dt) -> blocks (chain, chrom, blk, b_start, b_end)."""
    w = Window.partitionBy("chain").orderBy("blk").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum(F.col("size") + F.col("dt")).over(w)
    at = F.col("t_start") + cum - F.col("dt")
    return steps.select("chain", "chrom", "blk", (at - F.col("size")).alias("b_start"), at.alias("b_end"))


def chain_gaps(blocks: DataFrame) -> DataFrame:
    """(chain, blk, g_start, g_end): what lies between a block and the next one."""
    w = Window.partitionBy("chain").orderBy("blk")
    gaps = blocks.select("chain", "blk", F.col("b_end").alias("g_start"), F.lead("b_start").over(w).alias("g_end"))
    return gaps.filter("g_end > g_start")


def block_exon_coverage(exons: DataFrame, blocks: DataFrame) -> DataFrame:
    """(tx, chain, n_exons, cov): bases of a transcript's exons in a chain's blocks.

    A chain has one chromosome. Pairs are counted where they meet, so only the inputs are shuffled.
    """
    left, right = exons.select("chrom", "tx", "exon", *E_RANGE), blocks.select("chrom", "chain", *B_RANGE)
    fold = local.covered(E_RANGE, B_RANGE, ["tx"], ["chain"], "exon")
    return local.local_overlaps(left, right, ["chrom"], ["tx"], E_RANGE, B_RANGE, fold, f"{local.typed(left, 'tx')}, {local.typed(right, 'chain')}, n_exons bigint, cov bigint")


def chain_spans(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("chain", "chrom").agg(F.min("b_start").alias("c_start"), F.max("b_end").alias("c_end"))


def transcript_spans(exons: DataFrame) -> DataFrame:
    return exons.groupBy("tx", "chrom").agg(F.min("e_start").alias("t_start"), F.max("e_end").alias("t_end"))


def chain_transcript_pairs(exons: DataFrame, blocks: DataFrame) -> DataFrame:
    """(chain, tx) whose spans overlap."""
    return interval_join(transcript_spans(exons), chain_spans(blocks), ["chrom"], ("t_start", "t_end"), ("c_start", "c_end"), 8192).select("chain", "tx")


def unaligned(exons: DataFrame, blocks: DataFrame) -> DataFrame:
    """(tx, reason) of transcripts that no chain reaches."""
    spans = transcript_spans(exons)
    chroms = blocks.select("chrom").distinct().withColumn("there", F.lit(True))
    # islands of chains instead of chains: a transcript meets an island or two, however many chains there are
    islands = merge_intervals(chain_spans(blocks).filter("c_end > c_start"), ["chrom"], "c_start", "c_end", ["chain"]).select("chrom", "m_start", "m_end")
    reached = interval_join(spans, islands, ["chrom"], ("t_start", "t_end"), ("m_start", "m_end"), 65536).select("tx")
    left = spans.join(reached, "tx", "left_anti")
    reason = F.when(F.col("there"), "UNALIGNED_TR").otherwise("UNCOV_CHROM")
    return left.join(chroms, "chrom", "left").select("tx", reason.alias("reason"))


def projection_features(exons: DataFrame, blocks: DataFrame, genes: DataFrame) -> DataFrame:
    """The integer features of each (tx, chain): exon_cover, body_cover, intr_cover, synt, tx_on_chain.

    synt counts the distinct genes with a covered exon on the chain.
    """
    synteny = synteny_counts(exons, blocks, genes)
    known = blocks.select("chrom", "chain", *B_RANGE).join(synteny, "chain", "left").na.fill(0, ["synt", "tx_on_chain"])
    bodies = transcript_spans(exons).selectExpr("chrom", "tx", "t_start AS k_start", "t_end AS k_end", "true AS body")
    parts = exons.selectExpr("chrom", "tx", "e_start AS k_start", "e_end AS k_end", "false AS body", "exon").unionByName(bodies, allowMissingColumns=True)
    schema = f"{local.typed(parts, 'tx')}, {local.typed(known, 'chain')}, exon_cover bigint, n_exons bigint, body_cover bigint, synt bigint, tx_on_chain bigint"
    rows = local.local_overlaps(parts, known, ["chrom"], ["tx"], ("k_start", "k_end"), B_RANGE, local.body_and_exons, schema)
    return rows.select("tx", "chain", "exon_cover", "n_exons", "body_cover", (F.col("body_cover") - F.col("exon_cover")).alias("intr_cover"), "synt", "tx_on_chain")


def synteny_counts(exons: DataFrame, blocks: DataFrame, genes: DataFrame) -> DataFrame:
    """(chain, synt, tx_on_chain): genes and transcripts of genes (gene, tx) with an exon that the chain covers.

    Homes are long, so that a chain's genes are counted in few of them.
    """
    left, right = exons.join(genes.select("tx", "gene").distinct(), "tx").select("chrom", "tx", "gene", *E_RANGE), blocks.select("chrom", "chain", *B_RANGE)
    schema = f"{local.typed(right, 'chain')}, {local.typed(left, 'gene')}, n bigint"
    met = local.local_overlaps(left, right, ["chrom"], ["tx"], E_RANGE, B_RANGE, local.partners, schema, 16 * local.HOME)
    # a row for each gene of a chain before they are counted, as tasks find it again
    each = met.groupBy("chain", "gene").agg(F.sum("n").alias("n"))
    return each.groupBy("chain").agg(F.count("gene").alias("synt"), F.sum("n").alias("tx_on_chain"))


def liftover(exons: DataFrame, blocks: DataFrame) -> DataFrame:
    """(tx, exon, chain, q_start, q_end): first and last aligned base of each exon in the query.

    blocks has q_start of each block; the query runs in the same direction. No extrapolation beyond
    the aligned bases.
    """
    forward = blocks.withColumns({"q_end": F.expr("q_start + b_end - b_start"), "codirected": F.lit(True)})
    found = _aligned_ends(exons, forward, ["tx", "exon"])
    return found.select("tx", "exon", "chain", F.col("q_lo").alias("q_start"), F.col("q_hi").alias("q_end"))


def _aligned_ends(exons: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., chain, t_lo, q_lo, t_hi, q_hi): first and last aligned base of the rows of each key and chain, found where they meet."""
    left, right = exons.select("chrom", *dict.fromkeys(["tx", *keys]), *E_RANGE), blocks.select("chrom", "chain", *B_RANGE, "q_start", "q_end", "codirected")
    schema = f"{local.typed(left, *keys)}, {local.typed(right, 'chain')}, t_lo bigint, q_lo bigint, t_hi bigint, q_hi bigint"
    return local.local_overlaps(left, right, ["chrom"], ["tx"], E_RANGE, B_RANGE, local.ends(E_RANGE, B_RANGE, keys, ["chain"]), schema)


def query_position(at: str) -> Column:
    """Where the reference base border ``at`` inside a block (b_start, q_start, q_end, codirected) lies in the query."""
    offset = F.col(at) - F.col("b_start")
    return F.when(F.col("codirected"), F.col("q_start") + offset).otherwise(F.col("q_end") - offset)


def subchains(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """regions (tx, chrom, k_start, k_end) -> (tx, chain, piece, t_start, t_end, p_start, p_end, dt, dq).

    The pieces of a chain's blocks inside each region, numbered from 1 along the reference, with
    their query range on the forward strand and the gaps to the next piece; null after the last.
    blocks (chain, chrom, b_start, b_end, q_start, q_end, codirected). A region counts by its name
    ``tx`` and chromosome; blocks that only touch it have no piece.
    """
    left, right = regions.select("tx", "chrom", "k_start", "k_end"), blocks.select("chain", "chrom", *B_RANGE, "q_start", "q_end", "codirected")
    schema = f"{local.typed(left, 'tx')}, {local.typed(right, 'chain')}, piece int, t_start bigint, t_end bigint, p_start bigint, p_end bigint, dt bigint, dq bigint"
    return local.local_overlaps(left, right, ["chrom"], ["tx"], ("k_start", "k_end"), B_RANGE, local.pieces, schema)


def cds_boundaries(exons: DataFrame, blocks: DataFrame) -> DataFrame:
    """(tx, chain, t_lo, t_hi, q_lo, q_hi): first and last aligned base of a transcript's exons on
    either side, without extrapolation; strands as in ``subchains``."""
    ends = _aligned_ends(exons, blocks, ["tx"])
    return ends.select("tx", "chain", "t_lo", "t_hi", F.least("q_lo", "q_hi").alias("q_lo"), F.greatest("q_lo", "q_hi").alias("q_hi"))


def exon_query_share(cover: DataFrame, spans: DataFrame) -> DataFrame:
    """(chain, exon_qlen): coding bases over the chain's query length.

    cover (tx, chain, n_exons, cov), spans (chain, q_len), the query length without what UTR exons
    align to. 0 if no transcript has two exons on the chain or there is no length.
    """
    sums = cover.groupBy("chain").agg(F.sum("cov").alias("cds"), F.max("n_exons").alias("most"))
    share = F.when((F.col("most") > 1) & (F.col("q_len") > 0), F.col("cds") / F.col("q_len")).otherwise(0.0)
    return spans.join(sums, "chain").select("chain", share.alias("exon_qlen"))


def tiling_candidates(cover: DataFrame, n_exons: DataFrame, most_cover: float = 1.33) -> DataFrame:
    """(tx, chain): chains of transcripts that may lie in fragments.

    cover (tx, chain, n_exons): exons that each chain touches; n_exons (tx, n). A transcript needs
    several chains, none with all exons, and at most ``most_cover`` chains an exon on average.
    """
    rule = cover.groupBy("tx").agg(F.count("*").alias("chains"), F.max("n_exons").alias("most"), F.sum("n_exons").alias("met")).join(n_exons, "tx")
    fit = rule.filter((F.col("chains") > 1) & (F.col("most") < F.col("n")) & (F.col("met") <= F.col("n") * most_cover)).select("tx")
    return cover.join(fit, "tx", "left_semi").select("tx", "chain")


def fragment_candidates(exons: DataFrame, blocks: DataFrame, most_cover: float = 1.33) -> DataFrame:
    """``tiling_candidates`` of the exons (tx, chrom, exon, e_start, e_end) that each chain's blocks touch, told where they meet."""
    n = exons.groupBy("tx").agg(F.countDistinct("exon").alias("n"))
    left, right = exons.join(n, "tx").select("chrom", "tx", "exon", "n", *E_RANGE), blocks.select("chrom", "chain", *B_RANGE)
    return local.local_overlaps(left, right, ["chrom"], ["tx"], E_RANGE, B_RANGE, local.fragments(most_cover), f"{local.typed(left, 'tx')}, {local.typed(right, 'chain')}")


def map_exons(exons: DataFrame, pairs: DataFrame | None, blocks: DataFrame, most_gap: int = 1_000_000, most_trim: int = 2000) -> DataFrame:
    """(tx, exon, chain, state, q_start, q_end, covered): where each exon of the pairs (tx, chain) lies in the query.

    exons (tx, chrom, exon, e_start, e_end), blocks (chain, chrom, blk, b_start, b_end, q_start,
    q_end, codirected). ``mapped``: blocks reach the exon; its ends are projected through the first
    and last of them, beyond them in a straight line, from 0 at least. A locus of five times the
    exon's length shrinks to 1.1 times, at its start if no block follows it in the query but one
    precedes it, else at its end. ``gap``: the exon lies in a gap whose query side is at least as
    long as the exon and at most ``most_gap``. ``out``: out of the chain. ``missing``: all else, also an
    exon of several blocks that protrudes over ``most_trim`` bases, or without a range. Only the
    first two have a range. Flanks of dangling ends and long introns are not corrected. Without ``pairs``
    all transcripts and chains are paired whose spans overlap; these are mapped where they meet, and only
    inputs are shuffled. Blocks of a chain don't overlap.
    """
    c = F.col
    chains = blocks.groupBy("chain", "chrom").agg(F.min("b_start").alias("c_start"), F.max("b_end").alias("c_end"), F.max("q_start").alias("_last"), F.min("q_end").alias("_first"))
    w = Window.partitionBy("chain").orderBy("blk")
    gap = F.when(c("codirected"), F.struct(c("q_end").alias("s"), F.lead("q_start").over(w).alias("e"))).otherwise(F.struct(F.lead("q_end").over(w).alias("s"), c("q_start").alias("e")))
    gaps = blocks.select("chain", "chrom", c("b_end").alias("g_start"), F.lead("b_start").over(w).alias("g_end"), gap.alias("g")).filter("g_end > g_start")
    if pairs is None:
        # a block with the gap behind it, so that a chain is met wherever it passes
        links = blocks.withColumns({"gap": F.lead("b_start").over(w), "g": gap}).filter("b_end > b_start").join(chains, ["chain", "chrom"])
        links = links.select(
            "chain", "chrom", "b_start", "b_end", "q_start", "q_end", F.coalesce("gap", F.lit(-(1 << 62))).alias("gap"), F.coalesce("g.s", F.lit(0)).alias("g_from"), F.coalesce("g.e", F.lit(0)).alias("g_to"),
            F.greatest("b_end", "gap").alias("reach"), "c_start", "c_end", c("_last").alias("last"), c("_first").alias("first"), "codirected",
        )
        left = exons.join(transcript_spans(exons), ["tx", "chrom"]).select("tx", "chrom", "exon", "e_start", "e_end", "t_start", "t_end")
        schema = f"{local.typed(left, 'tx', 'exon')}, {local.typed(links, 'chain')}, state string, q_start bigint, q_end bigint, covered bigint"
        return local.local_overlaps(left, links, ["chrom"], ["tx"], ("t_start", "t_end"), ("b_start", "reach"), local.mapped(most_gap, most_trim), schema, local.HOME, local.Links, ("c_start", "c_end"))
    key = ["tx", "exon", "chain"]
    block = F.struct("b_start", "b_end", "q_start", "q_end")
    shared = overlap(c("e_start"), c("e_end"), c("b_start"), c("b_end"))
    met = interval_join(exons, blocks, ["chrom"], ("e_start", "e_end"), ("b_start", "b_end")).groupBy(*key).agg(F.min(block).alias("up"), F.max(block).alias("down"), F.sum(shared).alias("covered"), F.first("codirected").alias("codirected"))
    inside = interval_join(exons, gaps, ["chrom"], ("e_start", "e_end"), ("g_start", "g_end"), 65536).filter("g_start <= e_start AND e_end <= g_end").select(*key, "g")
    rows = exons.join(pairs.select("tx", "chain"), "tx").join(chains, ["chain", "chrom"]).join(met, key, "left").join(inside, key, "left")
    low = F.when(c("codirected"), c("up.q_start") + c("e_start") - c("up.b_start")).otherwise(c("down.q_end") - c("e_end") + c("down.b_start"))
    high = F.when(c("codirected"), c("down.q_start") + c("e_end") - c("down.b_start")).otherwise(c("up.q_end") - c("e_start") + c("up.b_start"))
    rows = rows.withColumns({"_lo": F.greatest(low, F.lit(0)), "_hi": F.greatest(high, F.lit(0)), "_n": c("e_end") - c("e_start"), "_gap": c("g.e") - c("g.s")})
    far = (c("up") != c("down")) & ((c("up.b_start") - c("e_start") > most_trim) | (c("e_end") - c("down.b_end") > most_trim))
    state = (
        F.when(c("up").isNotNull(), F.when(far | (c("_lo") >= c("_hi")), "missing").otherwise("mapped"))
        .when((c("e_end") < c("c_start")) | (c("e_start") > c("c_end")), "out")
        .when((c("_gap") >= c("_n")) & (c("_gap") <= most_gap), "gap")
        .otherwise("missing")
    )
    size, wide = F.floor(c("_n") * 11 / 10), c("_hi") - c("_lo") >= c("_n") * 5
    at_start = (c("_last") <= c("_hi")) & (c("_first") < c("_lo"))
    start = F.when(wide & ~at_start, F.greatest(F.lit(0), c("_hi") - size)).otherwise(c("_lo"))
    end = F.when(wide & at_start, c("_lo") + size).otherwise(c("_hi"))
    pick = lambda mapped, g: F.when(c("state") == "mapped", mapped).when(c("state") == "gap", g)
    return rows.withColumn("state", state).select(*key, "state", pick(start, c("g.s")).alias("q_start"), pick(end, c("g.e")).alias("q_end"), F.coalesce("covered", F.lit(0)).alias("covered"))
