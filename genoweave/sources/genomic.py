"""Readers and writers of BED12, chain, FASTA, isoform, intron and score files.

All are Spark text scans: records are split by the reader itself, so a folder of many files is read
in parallel and nothing passes through the driver. Coordinates are half-open, from 0, on the forward
strand. Malformed rows give nulls, which callers filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.functions.sequence import chunks

BED12 = "chrom string, start long, end long, name string, score string, strand string, thick_start long, thick_end long, rgb string, n_blocks int, sizes string, starts string"
CHAIN_HEADER = ["score", "t_name", "t_size", "t_strand", "t_start", "t_end", "q_name", "q_size", "q_strand", "q_start", "q_end", "chain"]  # fixed values
_NAMES = ("t_name", "t_strand", "q_name", "q_strand")


def _longs(csv: str) -> Column:
    """A comma list, with or without a trailing comma, as an array of longs."""
    return F.transform(F.split(F.rtrim(csv, F.lit(",")), ","), lambda x: x.try_cast("bigint"))


def read_bed12(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, name, score, strand, thick_start, thick_end, rgb and blocks (array of s, e)."""
    rows = spark.read.schema(BED12).option("sep", "\t").option("comment", "#").csv(path)
    ends = F.zip_with(_longs("starts"), _longs("sizes"), lambda s, n: F.struct((F.col("start") + s).alias("s"), (F.col("start") + s + n).alias("e")))
    return rows.select("chrom", "start", "end", "name", "score", "strand", "thick_start", "thick_end", "rgb", ends.alias("blocks"))


def bed12_lines(rows: DataFrame) -> DataFrame:
    """rows as from :func:`read_bed12` -> (value): one BED12 line each."""
    csv = lambda f: F.array_join(F.transform("blocks", f), ",")
    parts = ["chrom", "start", "end", "name", "score", "strand", "thick_start", "thick_end", "rgb", F.size("blocks"), csv(lambda b: b["e"] - b["s"]), csv(lambda b: b["s"] - F.col("start"))]
    return rows.select(F.concat_ws("\t", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]).alias("value"))


def read_chains(spark: SparkSession, path: str) -> DataFrame:
    """The chain headers, with ``steps`` as an array of (size, dt, dq): one row a chain.

    A record ends where a line starts with ``chain``; lines of comments are skipped. Spans of a
    minus strand are turned to the forward strand, in t_start, t_end, q_start and q_end.
    """
    text = spark.read.option("lineSep", "\nchain ").text(path)
    lines = F.filter(F.split("value", "\n"), lambda x: ~x.startswith("#") & (F.trim(x) != ""))
    rows = text.select(lines.alias("l")).filter(F.size("l") > 0)
    head = F.split(F.regexp_replace(F.element_at("l", 1), "^chain ", ""), r"\s+")
    fields = [F.try_element_at(head, F.lit(i + 1)).try_cast("string" if c in _NAMES else "bigint").alias(c) for i, c in enumerate(CHAIN_HEADER)]
    step = lambda x: F.split(F.trim(x), r"\s+")
    number = lambda x, i: F.coalesce(F.try_element_at(step(x), F.lit(i)).try_cast("bigint"), F.lit(0))
    steps = F.transform(F.slice("l", F.lit(2), F.size("l")), lambda x: F.struct(number(x, 1).alias("size"), number(x, 2).alias("dt"), number(x, 3).alias("dq")))
    rows = rows.select(*fields, steps.alias("steps"))
    flip = {}
    for side in "tq":
        minus, size, start, end = F.col(f"{side}_strand") == "-", *[F.col(f"{side}_{c}") for c in ("size", "start", "end")]
        flip |= {f"{side}_start": F.when(minus, size - end).otherwise(start), f"{side}_end": F.when(minus, size - start).otherwise(end)}
    return rows.withColumns(flip)


def aligned_blocks(chains: DataFrame) -> DataFrame:
    """chains as from :func:`read_chains` -> (chain, chrom, blk, b_start, b_end, q_name, q_from, q_to).

    Running sums over a chain's steps; on a minus query strand blocks run down from q_end. The
    reference strand must be the forward one.
    """
    steps = chains.select("chain", F.col("t_name").alias("chrom"), "t_start", "q_name", "q_strand", "q_start", "q_end", F.posexplode("steps").alias("blk", "s"))
    w = Window.partitionBy("chain").orderBy("blk").rowsBetween(Window.unboundedPreceding, 0)
    t = F.sum(F.col("s.size") + F.col("s.dt")).over(w) - F.col("s.dt")
    q = F.sum(F.col("s.size") + F.col("s.dq")).over(w) - F.col("s.dq")
    rows = steps.withColumns({"t": t, "q": q, "n": F.col("s.size")})
    minus = F.col("q_strand") == "-"
    return rows.select(
        "chain", "chrom", F.col("blk").cast("bigint").alias("blk"), (F.col("t_start") + F.col("t") - F.col("n")).alias("b_start"), (F.col("t_start") + F.col("t")).alias("b_end"), "q_name",
        F.when(minus, F.col("q_end") - F.col("q")).otherwise(F.col("q_start") + F.col("q") - F.col("n")).alias("q_from"),
        F.when(minus, F.col("q_end") - F.col("q") + F.col("n")).otherwise(F.col("q_start") + F.col("q")).alias("q_to"),
    )


def swap_chains(chains: DataFrame) -> DataFrame:
    """The same chains seen from the query: sides swapped, and the order of steps turned on a minus
    strand, so that the new reference strand is the forward one again."""
    n = F.size("steps")
    gaps = F.when(n > 1, F.reverse(F.slice("steps", F.lit(1), n - 1))).otherwise(F.slice("steps", 1, 0))
    turned = F.zip_with(F.reverse("steps"), gaps, lambda s, g: F.struct(s["size"].alias("size"), F.coalesce(g["dq"], F.lit(0)).alias("dt"), F.coalesce(g["dt"], F.lit(0)).alias("dq")))
    same = F.transform("steps", lambda s: F.struct(s["size"].alias("size"), s["dq"].alias("dt"), s["dt"].alias("dq")))
    swapped = {f"{a}_{c}": F.col(f"{b}_{c}") for a, b in ("tq", "qt") for c in ("name", "size", "start", "end")}
    return chains.withColumns(swapped | {"steps": F.when(F.col("q_strand") == "-", turned).otherwise(same)})


def chain_lines(chains: DataFrame) -> DataFrame:
    """chains as from :func:`read_chains` -> (value): a chain's lines and the empty line after it."""
    back = {}
    for side in "tq":
        minus, size, start, end = F.col(f"{side}_strand") == "-", *[F.col(f"{side}_{c}") for c in ("size", "start", "end")]
        back |= {f"{side}_start": F.when(minus, size - end).otherwise(start), f"{side}_end": F.when(minus, size - start).otherwise(end)}
    head = F.concat_ws(" ", F.lit("chain"), *[F.col(c).cast("string") for c in CHAIN_HEADER])
    last = F.size("steps") - 1
    steps = F.transform("steps", lambda s, i: F.when(i == last, s["size"].cast("string")).otherwise(F.concat_ws("\t", s["size"], s["dt"], s["dq"])))
    return chains.withColumns(back).select(F.concat(head, F.lit("\n"), F.array_join(steps, "\n"), F.lit("\n")).alias("value"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, seq): a record starts where a line starts with ``>``; white space in sequences goes.

    A sequence is one row, so a contig must stay under 2 GB; :func:`tiles` cuts contigs for joins.
    """
    text = spark.read.option("lineSep", "\n>").text(path).filter(F.trim("value") != "")
    record = F.regexp_replace("value", "^>", "")
    head = F.substring_index(record, "\n", 1)
    rest = F.substr(record, F.length(head) + 1, F.length(record))
    return text.select(F.trim(head).alias("header"), F.regexp_replace(rest, r"\s", "").alias("seq"))


def fasta_lines(rows: DataFrame, header: str, seq: str) -> DataFrame:
    """(value): a record of two lines for each row."""
    return rows.select(F.concat(F.lit(">"), F.col(header).cast("string"), F.lit("\n"), F.coalesce(F.col(seq), F.lit(""))).alias("value"))


def tiles(contigs: DataFrame, size: int = 1 << 16) -> DataFrame:
    """(header, seq) -> (chrom, tile, seq): a genome table with random access by (chrom, tile); an empty contig is one empty tile."""
    parts = F.when(F.length("seq") > 0, chunks(F.col("seq"), size)).otherwise(F.array(F.lit("")))
    return contigs.select(F.col("header").alias("chrom"), F.posexplode(parts).alias("tile", "seq"))


def fetch(regions: DataFrame, genome: DataFrame, size: int = 1 << 16) -> DataFrame:
    """regions (id, chrom, start, end) -> (id, seq) out of a :func:`tiles` table of that ``size``.

    Regions meet only the tiles that they touch; what lies beyond a contig's end is cut, and a region
    without a base has no row.
    """
    touched = regions.filter("end > start").withColumn("tile", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    g = genome.select(F.col("chrom"), F.col("tile").cast("bigint").alias("tile"), "seq")
    low = F.greatest(F.lit(0), F.col("start") - F.col("tile") * size)
    high = F.least(F.lit(size), F.col("end") - F.col("tile") * size)
    part = F.substr("seq", (low + 1).cast("int"), (high - low).cast("int"))
    got = touched.join(g, ["chrom", "tile"]).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("tile", part.alias("p")))).alias("ps"))
    return got.select("id", F.array_join(F.transform("ps", lambda x: x["p"]), "").alias("seq")).filter("seq <> ''")


def read_isoforms(spark: SparkSession, path: str) -> DataFrame:
    """(gene, tx) of a two-column file; transcripts without a gene are their own gene."""
    rows = spark.read.schema("gene string, tx string").option("sep", "\t").csv(path).filter("tx is not null")
    return rows.select(F.coalesce("gene", "tx").alias("gene"), "tx").distinct()


def read_introns(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, strand, kind, donor, acceptor, regular) of BED6 named intronN_KIND_DONOR-ACCEPTOR.

    An intron is regular from gt (of kind U2 also gc) to ag; ``nn`` passes at either site.
    """
    rows = spark.read.schema("chrom string, start long, end long, name string, score string, strand string").option("sep", "\t").csv(path)
    part = lambda i: F.regexp_extract("name", "_([^_]+)_([^_-]+)-([^_-]+)$", i)
    rows = rows.select("chrom", "start", "end", "strand", part(1).alias("kind"), F.lower(part(2)).alias("donor"), F.lower(part(3)).alias("acceptor"))
    donor = F.col("donor").isin("gt", "nn") | ((F.col("kind") == "U2") & (F.col("donor") == "gc"))
    return rows.withColumn("regular", donor & F.col("acceptor").isin("ag", "nn"))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(name, score) of a two-column file; what isn't a whole number counts as 0."""
    rows = spark.read.schema("name string, score string").option("sep", "\t").csv(path)
    return rows.select("name", F.coalesce(F.col("score").try_cast("bigint"), F.lit(0)).alias("score"))


def write_lines(lines: DataFrame, path: str, compression: str = "none") -> None:
    """A (value) table as a folder of text files; Spark's commit marks it complete."""
    lines.write.option("compression", compression).text(path)


def write_table(rows: DataFrame, path: str, compression: str = "none") -> None:
    """Any flat table as tab-separated files with a header."""
    rows.write.option("sep", "\t").option("header", True).option("compression", compression).csv(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(a, b, score) of a substitution matrix: a line of column letters, then a letter and its scores a line; # begins a comment."""
    text = spark.read.text(path, wholetext=True)
    lines = F.filter(F.split("value", "\r?\n"), lambda x: ~F.regexp_like(x, F.lit(r"^\s*(#.*)?$")))
    rows = text.select(F.split(F.trim(lines[0]), r"\s+").alias("head"), F.explode(F.slice(lines, F.lit(2), F.size(lines))).alias("line"))
    cells = rows.select("head", F.split(F.trim("line"), r"\s+").alias("x")).select(F.col("x")[0].alias("a"), F.explode(F.arrays_zip(F.col("head").alias("b"), F.slice("x", F.lit(2), F.size("x")).alias("s"))).alias("c"))
    return cells.select("a", "c.b", F.col("c.s").cast("bigint").alias("score"))
