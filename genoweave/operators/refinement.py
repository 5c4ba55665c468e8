"""Refinement of projections: splice-site calls, masking of mutations, rescued ends, search spaces, admission and annotation gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.sequence import STOPS, chunks

# Intact splice sites, mutation classes and reasons that masking looks at.
ACCEPTORS, DONORS = ("ag",), ("gt", "gc")
DELETED, MISSING, COMPENSATION = "Deleted exon", "Missing exon", "COMPENSATION"
NEVER_INACTIVATING = ("BIG_INS", "BIG_DEL", COMPENSATION, MISSING, "START_MISSING", "STOP_MISSING", "INTRON_GAIN")
KEPT_REASONS = ("U12 intron", "Non-canonical U2 intron", "Intron deletion", "Alternative frame found", "Exon is deleted", "Exon is missing")
COMPENSATED = ("Compensated", "Alternative frame found")


def splice_site_mutations(exons: DataFrame) -> DataFrame:
    """(tx, exon, class, ref_site, site, reason): splice sites that aren't intact; a reason means masked.

    exons (tx, exon, n_exons, aligned, acceptor, donor, ref_acceptor, ref_donor, acceptor_u12,
    donor_u12, intron_deleted), one row an exon; intron_deleted is of the intron after it. The outer
    sides of terminal exons and exons that aren't aligned have no call. First reason that holds: an
    n in the site, under two bases, an acceptor after a deleted intron whose donor is mutated too
    (which masks that donor as well), a U12 site, a reference site that isn't canonical itself.
    """
    c = F.col
    w = Window.partitionBy("tx").orderBy("exon")
    a, d = F.lower("acceptor"), F.lower("donor")
    hit_a, hit_d = c("aligned") & (c("exon") > 1) & ~a.isin(*ACCEPTORS), c("aligned") & (c("exon") < c("n_exons")) & ~d.isin(*DONORS)
    rows = exons.withColumns({"_a": hit_a, "_d": hit_d})
    clear = ~F.contains(a, F.lit("n")) & (F.length(a) == 2)
    rows = rows.withColumn("_gone", F.coalesce(c("_a") & clear & F.lag(c("_d") & c("intron_deleted")).over(w), F.lit(False)))
    rows = rows.withColumn("_gone_after", F.coalesce(F.lead("_gone").over(w), F.lit(False)))

    def side(kind: str, hit: str, site: Column, ref: str, u12: str, intact: tuple[str, ...], gone: str) -> Column:
        short = F.when(F.contains(site, F.lit("n")), "Ambiguous symbol").when(F.length(site) < 2, "Insufficient data")
        own = F.when(c(u12), "U12 intron").when(~F.lower(ref).isin(*intact), "Non-canonical U2 intron")
        reason = F.when(c(gone), "Intron deletion").otherwise(F.coalesce(short, own))
        padded = F.lpad(site, 2, "?") if kind == "SSMA" else F.rpad(site, 2, "?")
        return F.when(c(hit), F.struct(F.lit(kind).alias("class"), c(ref).alias("ref_site"), F.when(c(gone), "--").otherwise(padded).alias("site"), reason.alias("reason")))

    calls = F.array_compact(F.array(side("SSMA", "_a", a, "ref_acceptor", "acceptor_u12", ACCEPTORS, "_gone"), side("SSMD", "_d", d, "ref_donor", "donor_u12", DONORS, "_gone_after")))
    return rows.select("tx", "exon", F.explode(calls).alias("m")).select("tx", "exon", "m.*")


def masked_mutations(mutations: DataFrame, exons: DataFrame, starts: DataFrame, mask_start: bool = False) -> DataFrame:
    """(proj, mut, class, reason): every mutation with the reason that masks it, null if it counts.

    mutations (proj, mut, class, exon, codon, n_codons, n_exons, reason), exons (proj, exon,
    presence), starts (proj, codon) of ATGs in the query. Mutations of deleted or missing exons are
    masked; so are those in the last tenth of the codons (``mask_start``: the first as well, but for
    deleted exons) and those before an ATG in the first tenth. Where an inactivating mutation stays
    unmasked, masks by position and by compensated frames are taken back for the whole projection.
    """
    c = F.col
    tenth = F.floor(c("n_codons") / 10)
    fate = exons.groupBy("proj", "exon").agg(F.max("presence").alias("presence"))
    sizes = mutations.groupBy("proj").agg(F.max("n_codons").alias("n_codons"))
    early = starts.withColumnRenamed("codon", "atg").join(sizes, "proj").filter(c("atg") <= tenth).groupBy("proj").agg(F.max("atg").alias("atg"))
    rows = mutations.join(fate, ["proj", "exon"], "left").join(early, "proj", "left")
    settled = c("reason").isNotNull() | c("class").isin(COMPENSATION, MISSING) | ((c("class") == DELETED) & (c("n_exons") == 1))
    by_exon = F.when(~c("class").isin(DELETED, MISSING), F.when(c("presence") == "D", "Exon is deleted").when(c("presence") != "I", "Exon is missing"))
    at_start = F.lit(mask_start) & (c("codon") <= tenth) & (c("class") != DELETED)
    by_place = F.when(at_start, "N-terminal").when(c("codon") >= c("n_codons") - tenth, "C-terminal").when(c("atg") > c("codon"), "Alternative start found")
    rows = rows.withColumn("_exon", F.when(~settled, by_exon)).withColumn("_place", F.when(~settled & c("_exon").isNull(), by_place))
    rows = rows.withColumn("_why", F.coalesce("reason", "_exon", "_place"))
    spared = F.coalesce(F.bool_or((c("class") == DELETED) & c("_place").isNotNull()).over(Window.partitionBy("proj", "exon")), F.lit(False))
    counts = ~c("class").isin(*NEVER_INACTIVATING) & ~((c("class") == DELETED) & spared) & c("_why").isNull()
    rows = rows.withColumn("_counts", counts).withColumn("_any", F.bool_or("_counts").over(Window.partitionBy("proj")))
    freed = c("_any") & (c("_place").isNotNull() | F.coalesce(c("reason").isin(*COMPENSATED), F.lit(False)))
    return rows.select("proj", "mut", "class", F.when(~freed, c("_why")).alias("reason"))


def alternative_start(query: Column, start: Column, ref_codon: Column) -> Column:
    """0-based start of the first codon: the nearest ATG upstream in frame, where only the reference
    has one at ``start``; position 0 is not looked at. Linear in the length."""
    frame = start % 3
    ahead = F.transform(chunks(F.substring(F.upper(query), frame + 1, start - frame), 3), lambda x, i: F.when((x == "ATG") & (frame + i * 3 > 0), frame + i * 3))
    lost = (F.upper(ref_codon) == "ATG") & (F.upper(F.substring(query, start + 1, F.lit(3))) != "ATG")
    return F.when(lost, F.coalesce(F.array_max(ahead), start)).otherwise(start)


def alternative_stop(query: Column, stop: Column, ref_codon: Column) -> Column:
    """0-based end of the last codon: past the nearest stop codon downstream in frame, where only the
    reference has one before ``stop``; a masked query codon (NNN) stays. Linear in the length."""
    last = F.substring(query, stop - 2, F.lit(3))
    lost = ref_codon.isin(*STOPS) & ~last.isin(*STOPS) & (F.upper(last) != "NNN")
    after = F.transform(chunks(F.substring(F.upper(query), stop + 1, F.length(query)), 3), lambda x, i: F.when(x.isin(*STOPS), stop + 3 + i * 3))
    return F.when(lost, F.coalesce(F.array_min(after), stop)).otherwise(stop)


def search_spaces(found: DataFrame, exons: DataFrame, factor: float = 1.2) -> DataFrame:
    """(proj, s_start, s_end): query ranges widened by ``factor`` times the reference distance to
    exons that weren't found at either end, inside the contig.

    found (proj, tx, first, last, low, high, q_start, q_end, forward, codirected, contig, retro):
    the exons wanted and those found, numbered along the transcript; ``forward`` is the
    transcript's strand, ``codirected`` whether it runs the same way in the query. Processed
    pseudogenes (``retro``) aren't widened. exons (tx, exon, e_start, e_end).
    """
    c = F.col
    at = lambda which, end: F.max(F.when(c("exon") == c(which), c(end)))
    ends = {f"{w}_{e[2]}": at(w, e) for w in ("first", "last", "low", "high") for e in ("e_start", "e_end")}
    keys = ["proj", "q_start", "q_end", "forward", "codirected", "contig", "retro"]
    rows = found.join(exons.select("tx", "exon", "e_start", "e_end"), "tx").groupBy(*keys).agg(*[e.alias(n) for n, e in ends.items()])
    up = F.when(c("forward"), c("low_s") - c("first_s")).otherwise(c("first_e") - c("low_e"))
    down = F.when(c("forward"), c("last_e") - c("high_e")).otherwise(c("high_s") - c("last_s"))
    wide = lambda x: F.when(c("retro"), 0).otherwise(F.floor(x * F.lit(float(factor))))
    before, after = F.when(c("codirected"), wide(up)).otherwise(wide(down)), F.when(c("codirected"), wide(down)).otherwise(wide(up))
    return rows.select("proj", F.greatest(F.lit(0), c("q_start") - before).alias("s_start"), F.greatest(F.lit(0), F.least(c("q_end") + after, "contig")).alias("s_end"))


def admission_rejects(classes: DataFrame, one2one_only: bool = False, orthologs_only: bool = False, most: int = 100) -> DataFrame:
    """(tx, chain, reason) of what isn't projected; chain is null where the transcript goes as a whole.

    ``one2one_only`` rejects transcripts with several orthologs, ``orthologs_only`` those with none.
    Chains past the ``most`` lowest ids of the best tier (orthologs, else spanning, else paralogs) are over the limit.
    """
    c = F.col
    tier = F.when(c("class") == "ORTH", 1).when(c("class") == "SPAN", 2).when(c("class") == "PARA", 3)
    w = Window.partitionBy("tx")
    rows = classes.withColumn("_t", tier).withColumn("_best", F.min("_t").over(w)).withColumn("_n", F.count(F.when(c("_t") == 1, 1)).over(w))
    several, none = F.lit(one2one_only) & (c("_n") > 1), F.lit(orthologs_only) & (c("_n") == 0)
    whole = rows.filter(several | none).select("tx", F.lit(None).cast(classes.schema["chain"].dataType).alias("chain"), F.when(several, "MULTIPLE_ORTHOLOGS").otherwise("NO_ORTHOLOGS").alias("reason")).distinct()
    used = rows.filter(~several & ~none & (c("_t") == c("_best"))).withColumn("_r", F.row_number().over(w.orderBy("chain")))
    return whole.unionByName(used.filter(c("_r") > most).select("tx", "chain", F.lit("LIMIT_EXCEEDED").alias("reason")))


def annotation_reasons(transcripts: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, frame: bool = True) -> DataFrame:
    """(name, reason): the first gate that rejects a transcript, null if none does.

    transcripts (name, chrom, cds_start, cds_end, blocks of (s, e)). Gates: letters of the name,
    contigs, an empty coding range, a coding length that three doesn't divide. A repeated name or a
    coding range that ends before it starts is an error.
    """
    c = F.col
    coding = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda n, b: n + F.greatest(F.lit(0), F.least(b["e"], c("cds_end")) - F.greatest(b["s"], c("cds_start"))))
    outside = (~c("chrom").isin(*include) if include is not None else F.lit(False)) | (c("chrom").isin(*exclude) if exclude else F.lit(False))
    reason = F.when(~F.rlike("name", F.lit(NAME)), "NAME").when(outside, "CONTIG").when(c("cds_start") == c("cds_end"), "NON_CODING").when(F.lit(frame) & (coding % 3 != 0), "FRAME")
    fatal = F.when(c("_n") > 1, F.concat(F.lit("name occurs twice: "), "name")).when(c("cds_end") < c("cds_start"), F.concat(F.lit("coding range ends before it starts: "), "name"))
    named = transcripts.withColumn("_n", F.count("*").over(Window.partitionBy("name")))
    return named.select("name", F.when(fatal.isNull(), reason).otherwise(F.raise_error(fatal)).alias("reason"))


# Fixed value: the letters of a name.
NAME = r"^[A-Za-z0-9#\-._|]*$"


def split_legacy_projection(name: Column) -> tuple[Column, Column]:
    """(tx, chain) of ``tx.chain``; the transcript may hold dots, and is empty where there is none."""
    return F.regexp_extract(name, r"^(?:(.*)\.)?([^.]*)$", 1), F.regexp_extract(name, r"^(?:(.*)\.)?([^.]*)$", 2)
