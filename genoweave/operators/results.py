"""Result tables: admissibility, output filters, pseudogene track, orthology table, gene names, cliques."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators.projections import status_rank


def complete_join(left: DataFrame, right: DataFrame, on: list[str], what: str) -> DataFrame:
    """Inner join that fails if a row of ``left`` has no partner; ``what`` names it in the error."""
    found = left.join(right.withColumn("_there", F.lit(True)), on, "left")
    return found.filter(F.when(F.col("_there"), True).otherwise(F.raise_error(F.concat_ws(" ", F.lit(f"no {what} for"), *on)))).drop("_there")


def group_admissibility(groups: DataFrame, memory: float, space: int) -> DataFrame:
    """(tx, grp, reason): why an exon group can't be aligned, null if it can.

    groups (tx, grp, mem, space, gaps, bases, n_exons, largest_missing): memory needed, bases of the
    search space, whether that has assembly gaps, reference bases and exons of the group, length of
    its largest exon out of the chain. A space of up to two bases, one under half of the group's
    bases (three tenths for a single exon) or a missing exon over 2,000 bases are insufficient.
    """
    c = F.col
    short = F.when(c("n_exons") > 1, c("bases") * 5 > c("space") * 10).otherwise(c("bases") * 3 > c("space") * 10)
    reason = (
        F.when(c("mem") > memory, "EXCEEDS_MEMORY")
        .when(c("space") > space, "EXCEEDS_SPACE")
        .when(short | (c("largest_missing") > 2000) | (c("space") <= 2), "INSUFFICIENT_SEARCH_SPACE")
    )
    return groups.select("tx", "grp", F.concat(reason, F.when(c("gaps"), "+GAP").otherwise("")).alias("reason"))


def dubious_orthologs(projections: DataFrame, most_qlen: float = 0.2, least_intron: float = 0.4, against_top: bool = False) -> DataFrame:
    """(tx, proj) that are no sure orthologs of their transcript.

    projections (tx, proj, prob, class, status, exon_qlen, intron_cover). The most probable
    projection (the smallest name on ties) is kept, and so are those as probable, paralogs,
    processed pseudogenes and fragmented ones. Others go if exon_qlen or intron_cover is off and
    their status isn't better than N, the rank that is effectively compared with; ``against_top``
    compares with the top projection's status instead. Nothing goes where the top has probability 0.
    """
    own = Window.partitionBy("tx").orderBy(F.desc_nulls_last("prob"), "proj")
    top = projections.withColumns({"_i": F.row_number().over(own), "_p": F.first("prob").over(own), "_s": F.first("status").over(own)})
    rank = lambda s: status_rank(F.coalesce(s, F.lit("N")))
    bar = rank(F.col("_s")) if against_top else F.lit(-1)
    rival = (F.col("_i") > 1) & (F.col("_p") > 0) & (F.col("prob") < F.col("_p")) & ~F.col("class").isin("PARA", "P_PGENE") & ~F.contains("proj", F.lit(","))
    off = (F.col("exon_qlen") > most_qlen) | (F.col("intron_cover") < least_intron)
    return top.filter(rival & (rank(F.col("status")) <= bar) & off).select("tx", "proj")


def output_bed(records: DataFrame, discarded: DataFrame, pseudogenes: DataFrame, intact: tuple[str, ...] = ("FI", "I")) -> DataFrame:
    """BED records (name, status, ...) for the output: discarded names go, processed pseudogenes stay
    only if intact, as ``name#retro``."""
    marked = pseudogenes.select("name").distinct().withColumn("_retro", F.lit(True))
    kept = records.join(discarded.select("name").distinct(), "name", "left_anti").join(marked, "name", "left")
    kept = kept.filter(F.col("_retro").isNull() | F.col("status").isin(*intact))
    return kept.withColumn("name", F.when(F.col("_retro"), F.concat("name", F.lit("#retro"))).otherwise(F.col("name"))).drop("_retro")


def pseudogene_track(projections: DataFrame) -> DataFrame:
    """projections (tx, chain, chrom, strand, q_start, q_end) -> (chrom, start, end, name, strand): a
    record for each group of a transcript's projections that overlap on one strand.

    The name is ``tx#chain,chain...`` in order of the start; the record ends where the last
    projection by start ends, which need not be the group's greatest end.
    """
    by = ["tx", "chrom", "strand"]
    w = Window.partitionBy(*by).orderBy("q_start", "q_end", "chain")
    reach = F.max("q_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = projections.withColumn("_new", F.when(F.col("q_start") < reach, 0).otherwise(1))
    rows = rows.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    groups = rows.groupBy(*by, "_g").agg(F.array_sort(F.collect_list(F.struct("q_start", "q_end", "chain"))).alias("p"))
    name = F.concat_ws("#", "tx", F.array_join(F.transform("p", lambda x: x["chain"].cast("string")), ","))
    return groups.select("chrom", F.element_at("p", 1)["q_start"].alias("start"), F.element_at("p", -1)["q_end"].alias("end"), name.alias("name"), "strand")


def orthology_table(members: DataFrame, isoforms: DataFrame, projections: DataFrame, query_genes: DataFrame | None = None) -> DataFrame:
    """(r, tx, q, proj, class): every projection between two genes of one component.

    members (comp, class, gene) has reference and query genes, isoforms (r, tx), projections
    (tx, proj), query_genes (proj, q). Without ``query_genes`` projections have their q themselves. Transcripts of
    one2zero genes have null q and proj.
    """
    if query_genes is not None:
        projections = projections.select("tx", "proj").join(query_genes.select("proj", "q"), "proj")
    refs = members.select("comp", "class", F.col("gene").alias("r")).join(isoforms, "r")
    linked = refs.filter("class <> 'one2zero'").join(projections.select("tx", "proj", "q"), "tx")
    linked = linked.join(members.select("comp", F.col("gene").alias("q")), ["comp", "q"], "left_semi").select("r", "tx", "q", "proj", "class")
    alone = refs.filter("class = 'one2zero'").select("r", "tx", F.lit(None).cast(linked.schema["q"].dataType).alias("q"), F.lit(None).cast(linked.schema["proj"].dataType).alias("proj"), "class")
    return linked.unionByName(alone)


def orthology_names(table: DataFrame) -> DataFrame:
    """(q, name): query genes named by their reference genes; table (r, q, chain, class).

    Reference genes stand in order of their lowest chain; beyond three, the first with ``+``. A gene
    of a one2many component takes a letter (a, b, ...), one of a many2many component a number, which
    count the reference gene's query genes in order of q; after z the letters go on in code points.
    """
    refs = table.filter("q is not null").groupBy("q", "r").agg(F.min("chain").alias("chain"), F.min("class").alias("class"))
    number = F.row_number().over(Window.partitionBy("class", "r").orderBy("q"))
    suffix = F.when(F.col("class") == "one2many", F.concat(F.lit("_"), F.char(96 + number))).when(F.col("class") == "many2many", F.concat(F.lit("_"), number)).otherwise("")
    named = refs.select("q", "chain", "r", F.concat("r", suffix).alias("n"))
    lists = named.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("chain", "r", "n"))).alias("l")).withColumn("l", F.transform("l", lambda x: x["n"]))
    return lists.select("q", F.when(F.size("l") > 3, F.concat(F.element_at("l", 1), F.lit("+"))).otherwise(F.array_join("l", ",")).alias("name"))


def rename(rows: DataFrame, names: DataFrame, gene: str) -> DataFrame:
    """Rows with ``gene`` replaced by its name of ``names`` (q, name); genes without one keep theirs."""
    new = names.select(F.col("q").alias("_q"), F.col("name").alias("_name"))
    return rows.join(new, F.col(gene) == F.col("_q"), "left").withColumn(gene, F.coalesce("_name", gene)).drop("_q", "_name")


def usable_cliques(sequences: DataFrame, least: int = 50) -> DataFrame:
    """(clique): those fit for a tree, where a sequence has ``least`` residues and none is undefined."""
    return sequences.groupBy("clique").agg(F.bool_or(F.length("seq") >= least).alias("long"), F.bool_or(undefined_only(F.col("seq"))).alias("bad")).filter("long and not bad").select("clique")


def pairs_of_cliques(cliques: DataFrame, pairs: DataFrame) -> DataFrame:
    """(clique, pairs): number of resolved pairs, 0 for cliques without one."""
    counts = pairs.groupBy("clique").agg(F.count("*").alias("pairs"))
    return cliques.select("clique").distinct().join(counts, "clique", "left").select("clique", F.coalesce("pairs", F.lit(0)).alias("pairs"))


def best_model(scores: DataFrame) -> DataFrame:
    """scores (clique, line, model, likelihood) -> (clique, model) of the highest score, the last line on ties."""
    return scores.groupBy("clique").agg(F.max_by("model", F.struct("likelihood", "line")).alias("model"))


def undefined_only(seq: Column) -> Column:
    """No residue but X and stops; true for an empty sequence."""
    return F.rlike(seq, F.lit("^[Xx*]*$"))


def ordered_region(region: Column) -> Column:
    """``chrom:a-b`` with the smaller coordinate first; anything else is left as it is."""
    parts = F.regexp_extract
    a, b = parts(region, r"^(.+):(\d+)-(\d+)$", 2).try_cast("bigint"), parts(region, r"^(.+):(\d+)-(\d+)$", 3).try_cast("bigint")
    return F.when(a > b, F.concat(parts(region, r"^(.+):(\d+)-(\d+)$", 1), F.lit(":"), b, F.lit("-"), a)).otherwise(region)


def intron_layout_score(coverage: Column, lost: Column, frame: Column) -> Column:
    """coverage ** (5 ** (frame is broken) / 2 ** lost)."""
    return F.pow(coverage, F.when(frame != 0, 5.0).otherwise(1.0) / F.pow(F.lit(2.0), lost))


def letters_till_codon(codons: DataFrame, key: str) -> DataFrame:
    """codons (key, codon, seq) -> (key, codon, till): letters up to and with each aligned codon."""
    w = Window.partitionBy(key).orderBy("codon").rowsBetween(Window.unboundedPreceding, 0)
    return codons.select(key, "codon", F.sum(F.length(F.regexp_replace("seq", "[^A-Za-z]", ""))).over(w).alias("till"))
