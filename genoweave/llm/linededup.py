"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm.common import LOWER, SPACES, UPPER, ascii_lower, documents, hash128, range_bucket
from genoweave.session import checkpointed, partitions, shared_path

MIN_CHARS = 20  # shorter keys are never dropped
MIN_DOCS = 3  # documents that must hold a key for it to be dropped
BATCHES = 4  # id ranges that the query adds one after the other
FANOUT = 2  # runs of one level that are compacted into one run of the next


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACES)))


class LineRuns:
    """Sorted runs (h1, h2, n_docs, keep), each a table bucketed by both hashes and sorted.

    All runs have as many buckets as a shuffle has partitions, so a batch or a run meets a run in a
    merge join that shuffles no run; Spark sorts each bucket again, as it doesn't rely on the order
    of files. ``add`` drops the keys that one run already counts ``min_docs`` times (their outcome is
    settled if batches come in descending id order) and writes the rest as a run of level 0;
    ``FANOUT`` runs of a level are merged into one of the next, counts added, and leave the catalogue.
    """

    def __init__(self, spark: SparkSession, buckets: int, min_docs: int = MIN_DOCS):
        self.spark, self.buckets, self.min_docs = spark, buckets, min_docs
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, keys: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        # rows come from an aggregate or a join by both hashes: a task holds whole buckets, one file each
        self.paths[name] = shared_path(self.spark, name)
        keys.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", self.paths[name]).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= FANOUT:
            merged, self.levels[level] = self.levels[level], []
            self._write(self._merge(merged), level + 1)
            for old in merged:
                self.spark.sql(f"DROP TABLE {old}")

    def _merge(self, names: list[str]) -> DataFrame:
        """A merge of sorted runs: full outer merge joins, bucket by bucket."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select("h1", "h2", F.col("n_docs").alias("m"), F.col("keep").alias("other"))
            rows = rows.join(other.hint("merge"), ["h1", "h2"], "full_outer").select(
                "h1",
                "h2",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n_docs"),
                F.greatest("keep", "other").alias("keep"),
            )
        return rows

    def add(self, keys: DataFrame) -> None:
        """keys: (h1, h2, n_docs, keep), a row for each key of the batch."""
        for name in [x for level in self.levels for x in level]:
            settled = self.spark.table(name).filter(F.col("n_docs") >= self.min_docs).select("h1", "h2")
            keys = keys.join(settled.hint("merge"), ["h1", "h2"], "left_anti")
        self._write(keys, 0)

    def totals(self) -> DataFrame:
        """All keys. One run is read as plain files: a join of every document's keys with it must stay
        a shuffle of both sides, as only then AQE splits a key that many documents hold."""
        names = [x for level in self.levels for x in level]
        if len(names) > 1:
            return self._merge(names)
        return self.spark.read.schema(self.spark.table(names[0]).schema).parquet(self.paths[names[0]])


def _keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, h1, h2) for every distinct long key of every document."""
    line = F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("line")
    keys = docs.select(F.col(id_col).alias("id"), line).select("id", line_key(F.col("line")).alias("key"))
    h1, h2 = hash128(F.col("key"))
    return keys.filter(F.char_length("key") >= min_chars).select("id", h1.alias("h1"), h2.alias("h2"))


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """(id, h1, h2) of the line keys that each document loses, found through the runs."""
    spark = docs.sparkSession
    keys = _keys(docs, id_col, text_col, min_chars)
    # a document counts once for a key; ids are unique but for repeated rows
    keys = checkpointed(keys.distinct())
    cuts = keys.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 10000).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    batched = keys.withColumn("batch", range_bucket(F.col("id"), cuts, F.lit))
    runs = LineRuns(spark, partitions(spark), min_docs)
    for batch in range(len(cuts), -1, -1):  # the largest ids first: they keep their lines
        part = batched.filter(F.col("batch") == batch)
        runs.add(part.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("keep")))
    gone = runs.totals().filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keep")
    return keys.join(gone, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keep"))).select("id", "h1", "h2")


def _bucket(h: Column, n: Column) -> Column:
    """Which of n equal parts of the signed 64-bit numbers holds ``h``."""
    return F.least(F.floor((h / F.lit(float(1 << 64)) + 0.5) * n).cast("int"), n - 1)


def _looked_up(lost: DataFrame) -> DataFrame:
    """lost (id, h1, h2) -> (id, lost, starts): a document's keys in order, and where those of each bucket begin.

    As hashes fall evenly into as many buckets as there are keys, a line meets a few keys only, and a
    text's lines take time in proportion to their number.
    """
    rows = lost.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("h1", "h2"))).alias("lost"))
    n = F.size("lost")
    of = lambda i: F.when(i < 0, -1).otherwise(_bucket(F.get("lost", i)["h1"], n))
    firsts = F.flatten(F.transform("lost", lambda x, i: F.array_repeat(i + 1, of(i) - of(i - 1))))
    return rows.select("id", "lost", F.concat(firsts, F.array_repeat(n + 1, n - of(n - 1))).alias("starts"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None, **limits) -> DataFrame:
    """(id, kept text, n_lines, n_dropped): each text without its repeated lines.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose all their lines except in the
    largest id that holds them. Null and empty texts are one empty line. Rows that share an id are
    one document for the counts and lose the same lines; a null id is the smallest. Repeated lines
    in one document count once. An empty table gives an empty result; other columns are ignored, but for
    ``carry``, which comes out as ``carried``, row by row.
    """
    min_chars = limits.get("min_chars", MIN_CHARS)
    lost = _looked_up(repeated_lines(docs, id_col, text_col, **limits))
    rows = docs.select(F.col(id_col).alias("own"), F.coalesce(F.col(text_col), F.lit("")).alias("body"), *([] if carry is None else [carry.alias("carried")]))
    joined = rows.join(lost.hint("shuffle_hash"), F.col("own").eqNullSafe(F.col("id")), "left").drop("id")

    def stays(x: Column) -> Column:
        at = _bucket(x["h1"], F.size("lost"))
        here = F.slice("lost", F.element_at("starts", at + 1), F.element_at("starts", at + 2) - F.element_at("starts", at + 1))
        return (F.char_length(x["line"]) < min_chars) | ~F.array_contains(here, F.struct(x["h1"].alias("h1"), x["h2"].alias("h2")))

    def hashed(line: Column) -> Column:
        h1, h2 = hash128(line_key(line))
        return F.struct(line.alias("line"), h1.alias("h1"), h2.alias("h2"))

    lines = F.split("body", "\n", -1)
    some = F.col("lost").isNotNull()
    kept = F.when(some, F.transform(F.filter(F.transform(lines, hashed), stays), lambda x: x["line"]))
    parts = joined.withColumn("kept", kept).withColumn("n_lines", F.size(lines).cast("bigint"))
    return parts.select(
        F.col("own").alias(id_col),
        F.when(F.col("kept").isNull(), F.col("body")).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
        "n_lines",
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        *([] if carry is None else ["carried"]),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def oracle_lines(docs: str) -> str:
    """Common table expressions: ``lined`` has every line of table ``docs`` with ``gone``."""
    return f"""
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {docs}) x),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
heavy AS (SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
lined AS (SELECT k.*, h.key IS NOT NULL AND h.keep <> k.doc_id AS gone FROM keyed k LEFT JOIN heavy h ON k.key = h.key)"""


SQL = f"""
WITH {oracle_lines("documents")}
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM lined GROUP BY doc_id
"""
