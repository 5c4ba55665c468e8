"""Projection operators: classification rules, admission, loss statuses, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ["N", "PP", "PG", "PM", "M", "L", "UL", "PI", "I", "FI"]  # fixed values, worst first: ranks -1 to 8


def status_rank(status: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STATUSES)), status) - 2


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where both are 0 or b is 0."""
    return F.when(b == 0, 0.0).otherwise(a / b)


def classify(features: DataFrame, threshold: int = 50, keep: tuple[str, ...] = ()) -> DataFrame:
    """features (tx, chain, synt, exon_cover, ex_fract, ex_num, qlen, clip_exon, clip_intr, pred, score) -> + class.

    Fractions are whole percent. Spanning pairs have no covered exon. A pair is a processed
    pseudogene by rule 1 (one gene on the chain, query length nearly all exon, low score, multi-exon
    with most exons covered), or by rule 2 (clipped evidence, for low scores or for orthologs below
    the best of a transcript with several); rule 1 is applied before rule 2 counts orthologs.
    """
    perc = ratio(F.col("exon_cover") * 100, F.col("ex_fract"))
    df = features.withColumn("span", F.col("exon_cover") == 0)
    rule1 = (F.col("synt") == 1) & (F.col("qlen") > 95) & (F.col("pred") < threshold) & (perc > 65) & (F.col("ex_num") > 1)
    df = df.withColumn("p1", F.when(F.col("span"), -1).when(rule1, -2).otherwise(F.col("pred")))
    own = Window.partitionBy("tx")
    above = F.count_if(F.col("p1") > threshold).over(own)
    best = F.when(above > 1, F.max("p1").over(own))
    evidence = (F.col("clip_exon") > 30) & (F.col("clip_intr") >= 0) & (F.col("clip_intr") < 10)
    rule2 = (F.col("p1") >= 0) & evidence & ((F.col("p1") < threshold) | F.coalesce(F.col("p1") < best, F.lit(False)))
    df = df.withColumn("p2", F.when(rule2, -2).otherwise(F.col("p1")))
    kind = F.when(F.col("p2") == -1, "SPAN").when(F.col("p2") == -2, "P_PGENE").when(F.col("p2") < threshold, "PARA").otherwise("ORTH")
    return df.select("tx", "chain", "score", F.col("p2").alias("pred"), kind.alias("class"), *keep)


def enough_score(classes: DataFrame, least: int) -> DataFrame:
    """Orthologs below ``least`` go; other classes pass."""
    return classes.filter((F.col("class") != "ORTH") | (F.col("score") >= least))


def class_lists(classes: DataFrame) -> DataFrame:
    """(tx, orth, para, span, p_pgene): comma lists of chains, '0' for none."""
    kinds = ["ORTH", "PARA", "SPAN", "P_PGENE"]
    lists = [F.array_join(F.array_sort(F.collect_list(F.when(F.col("class") == k, F.col("chain")))), ",") for k in kinds]
    return classes.groupBy("tx").agg(*[F.when(x == "", "0").otherwise(x).alias(k.lower()) for k, x in zip(kinds, lists, strict=True)])


def admit(classes: DataFrame, most: int = 100) -> DataFrame:
    """The chains that a transcript is projected through: its orthologs, else spanning, else paralogs;
    the lowest chain ids first, ``most`` at most (100 as in the reference); processed pseudogenes come in addition."""
    tier = F.when(F.col("class") == "ORTH", 1).when(F.col("class") == "SPAN", 2).when(F.col("class") == "PARA", 3)
    rows = classes.withColumn("tier", tier)
    best = rows.filter("tier is not null").withColumn("best", F.min("tier").over(Window.partitionBy("tx"))).filter("tier = best")
    ranked = best.withColumn("r", F.row_number().over(Window.partitionBy("tx").orderBy("chain"))).filter(F.col("r") <= most)
    return ranked.select("tx", "chain", "class").unionByName(rows.filter(F.col("class") == "P_PGENE").select("tx", "chain", "class"))


def best_status(df: DataFrame, by: list[str]) -> DataFrame:
    """(by..., status): the status of the highest rank."""
    return df.groupBy(*by).agg(F.max_by("status", status_rank(F.col("status"))).alias("status"))


def loss_rollup(projections: DataFrame, genes: DataFrame) -> DataFrame:
    """projections (tx, chain, class, status), genes (gene, tx) -> (level, entry, status).

    Transcripts ignore processed pseudogenes and count paralogs as PG; isoforms without a
    projection are N.
    """
    proj = projections.select(F.lit("PROJECTION").alias("level"), F.concat_ws("#", "tx", "chain").alias("entry"), "status")
    counted = projections.filter(F.col("class") != "P_PGENE").withColumn("status", F.when(F.col("class") == "PARA", "PG").otherwise(F.col("status")))
    tx = best_status(counted, ["tx"])
    gene = best_status(genes.join(tx, "tx", "left").withColumn("status", F.coalesce("status", F.lit("N"))), ["gene"])
    named = lambda df, level, c: df.select(F.lit(level).alias("level"), F.col(c).cast("string").alias("entry"), "status")
    return proj.unionByName(named(tx, "TRANSCRIPT", "tx")).unionByName(named(gene, "GENE", "gene"))


def span_precedence(spans: DataFrame) -> DataFrame:
    """spans (tx, chain, g_start, g_end) -> the narrowest of each transcript, lowest chain on ties."""
    return spans.groupBy("tx").agg(F.min_by("chain", F.struct(F.col("g_end") - F.col("g_start"), F.col("chain"))).alias("chain"))


def loss_ladder(m: DataFrame) -> DataFrame:
    """First matching rule over transcript metrics in whole percent: (tx, status)."""
    c = F.col
    tail = F.when((c("strict") < 60) & ((c("n_affected") >= F.when(c("n_exons") <= 1, 1).when(c("n_exons") <= 10, 2).otherwise(c("n_exons") / 5)) | c("big_exon")), "L").otherwise("UL")
    status = (
        F.when((c("n_crit") == 0) & (c("strict") > 60), F.when(c("preserving"), "FI").otherwise("I"))
        .when(c("all_deleted") | (c("total") < 35) | (c("relaxed") < 20), "L")
        .when(c("all_missing"), "M")
        .when(c("mid_intact") & (c("total") < 49), "UL")
        .when(c("mid_intact") & ((c("missing") == 0) | c("mid_present")), "I")
        .when(c("mid_intact") & (c("missing") < 50), "PI")
        .when(c("mid_intact"), "M")
        .when(c("n_exons") == 1, F.when((c("n_affecting") > 1) & (c("strict") < 60), "L").otherwise("UL"))
        .otherwise(tail)
    )
    return m.select("tx", status.alias("status"))


def exon_quality(nuc: Column, blosum: Column) -> Column:
    return F.when((nuc >= 75) & (blosum >= 65), "HQ").when((nuc >= 65) & (blosum >= 40), "AQ").when((nuc >= 45) & (blosum >= 25), "LQ").otherwise("NA")


def runs(df: DataFrame, by: list[str], order: list[str], flag: Column) -> DataFrame:
    """Maximal runs of flagged rows: by..., first, last (of the first order column), n."""
    hit = df.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(flag)
    grouped = hit.withColumn("_g", F.col("_i") - F.row_number().over(Window.partitionBy(*by).orderBy("_i")))
    return grouped.groupBy(*by, "_g").agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("n")).drop("_g")


def memory_bins(df: DataFrame, bins: list[int], limit: int) -> DataFrame:
    """(tx, mem, bin): the smallest bin that holds ``mem``, 'big' up to the limit, else 'HEAVY'."""
    out = F.when(F.col("mem") > limit, "HEAVY")
    for b in sorted(bins):
        out = out.when(F.col("mem") <= b, str(b))
    return df.select("tx", "mem", out.otherwise("big").alias("bin"))


def query_gene_names(pairs: DataFrame) -> DataFrame:
    """pairs (q, r) -> (q, name): up to three reference genes joined by commas, '+' beyond; query genes
    of one single reference gene get _1, _2, ... in order of q."""
    refs = pairs.groupBy("q").agg(F.array_sort(F.collect_set("r")).alias("rs"))
    base = F.when(F.size("rs") > 3, F.concat(F.array_join(F.slice("rs", 1, 3), ","), F.lit("+"))).otherwise(F.array_join("rs", ","))
    named = refs.withColumn("base", base)
    own = Window.partitionBy("base")
    number = F.row_number().over(own.orderBy("q"))
    return named.select("q", F.when(F.count("*").over(own) > 1, F.concat_ws("_", "base", number)).otherwise(F.col("base")).alias("name"))
