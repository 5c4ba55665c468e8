"""Deterministic genomic views over the test tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.operators import chains


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS tx", "concat('chr', l_orderkey % 5) AS chrom", "CAST(l_linenumber AS BIGINT) AS exon",
        "(l_orderkey * 7919) % 2000000 + (CAST(l_linenumber AS BIGINT) - 1) * 400 AS e_start",
        "(l_orderkey * 7919) % 2000000 + (CAST(l_linenumber AS BIGINT) - 1) * 400 + CAST(l_quantity AS BIGINT) * 3 AS e_end",
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "events").selectExpr(
        "user_id AS chain", "concat('chr', user_id % 5) AS chrom", "event_id AS blk", "(user_id * 104729) % 2000000 AS t_start",
        "20 + (event_id * 13) % 60 AS size", "(event_id * 31) % 500 AS dt",
    )
    return chains.chain_blocks(steps)


def isoforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_custkey % 500 AS gene", "o_orderkey AS tx")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in FEATURES.items()])


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr("concat('R', l_orderkey) AS r", f"{QUERY_GENE.format('div')} AS q", "(l_orderkey * 37 + l_linenumber) % 1000 AS weight")
    return rows.groupBy("r", "q").agg(F.max("weight").alias("weight"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("doc_id", "regexp_replace(upper(text), '[^ACGT]+', '') AS seq")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in METRICS.items()])


# The same expressions serve Spark and the oracle.
FEATURES = {
    "tx": "l_orderkey",
    "chain": "CAST(l_linenumber * 10 + l_partkey % 7 AS BIGINT)",
    "synt": "CAST(1 + l_partkey % 3 AS BIGINT)",
    "exon_cover": "CASE WHEN l_suppkey % 7 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) * 3 END",
    "ex_fract": "CAST(l_quantity AS BIGINT) * 3 + l_suppkey % 50",
    "ex_num": "CAST(1 + l_orderkey % 6 AS BIGINT)",
    "qlen": "CAST((l_partkey * 13 + l_linenumber) % 101 AS BIGINT)",
    "clip_exon": "CAST((l_suppkey * 29 + l_partkey) % 101 AS BIGINT)",
    "clip_intr": "CAST((l_orderkey + l_partkey) % 30 - 1 AS BIGINT)",
    "pred": "CAST((l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 101 AS BIGINT)",
    "score": "CAST((l_partkey * 97) % 40000 AS BIGINT)",
    "status": "CASE l_orderkey * l_linenumber % 9 WHEN 0 THEN 'FI' WHEN 1 THEN 'I' WHEN 2 THEN 'PI' WHEN 3 THEN 'UL' WHEN 4 THEN 'M' WHEN 5 THEN 'L' WHEN 6 THEN 'PM' WHEN 7 THEN 'PG' ELSE 'N' END",
}
METRICS = {
    "tx": "o_orderkey",
    "n_exons": "1 + o_orderkey % 15",
    "n_crit": "o_orderkey % 4",
    "strict": "(o_orderkey * 7) % 101",
    "relaxed": "(o_orderkey * 11) % 101",
    "total": "(o_orderkey * 13) % 101",
    "missing": "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE (o_orderkey * 17) % 101 END",
    "n_affected": "o_orderkey % 5",
    "n_affecting": "o_orderkey % 3",
    "preserving": "o_orderkey % 2 = 0",
    "all_deleted": "o_orderkey % 23 = 0",
    "all_missing": "o_orderkey % 19 = 0",
    "mid_intact": "o_orderkey % 5 < 2",
    "mid_present": "o_orderkey % 7 < 3",
    "big_exon": "o_orderkey % 11 = 0",
}

# every line is an edge: components of up to 64 reference genes, and of each class; {0} divides integers
QUERY_GENE = """CASE WHEN l_orderkey {0} 64 % 16 = 0 THEN concat('Q', l_orderkey {0} 64, 'h', l_partkey % 40) WHEN l_orderkey {0} 8 % 4 = 0 THEN concat('Q', l_orderkey)
  WHEN l_orderkey {0} 8 % 4 = 1 THEN concat('Q', l_orderkey, '_', l_partkey % 3) WHEN l_orderkey {0} 8 % 4 = 2 THEN concat('Q', l_orderkey {0} 2, 'p') ELSE concat('Q', l_orderkey {0} 8, 'b', l_partkey % 13) END"""

EXONS = """exons AS (SELECT l_orderkey AS tx, 'chr' || CAST(l_orderkey % 5 AS VARCHAR) AS chrom, CAST(l_linenumber AS BIGINT) AS exon,
  (l_orderkey * 7919) % 2000000 + (CAST(l_linenumber AS BIGINT) - 1) * 400 AS e_start,
  (l_orderkey * 7919) % 2000000 + (CAST(l_linenumber AS BIGINT) - 1) * 400 + CAST(l_quantity AS BIGINT) * 3 AS e_end FROM lineitem)"""
BLOCKS = """blocks AS (SELECT chain, chrom, blk, t_start + cum - size - dt AS b_start, t_start + cum - dt AS b_end FROM (
  SELECT user_id AS chain, 'chr' || CAST(user_id % 5 AS VARCHAR) AS chrom, event_id AS blk, (user_id * 104729) % 2000000 AS t_start,
    20 + (event_id * 13) % 60 AS size, (event_id * 31) % 500 AS dt,
    CAST(sum(20 + (event_id * 13) % 60 + (event_id * 31) % 500) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cum FROM events) z)"""
SPANS = """ts AS (SELECT tx, chrom, min(e_start) AS t_start, max(e_end) AS t_end FROM exons GROUP BY tx, chrom),
cs AS (SELECT chain, chrom, min(b_start) AS c_start, max(b_end) AS c_end FROM blocks GROUP BY chain, chrom)"""
ISOFORMS = "isoforms AS (SELECT o_custkey % 500 AS gene, o_orderkey AS tx FROM orders)"
FEATURE_CTE = f"features AS (SELECT {', '.join(f'{e} AS {c}' for c, e in FEATURES.items())} FROM lineitem)"
METRIC_CTE = f"metrics AS (SELECT {', '.join(f'{e} AS {c}' for c, e in METRICS.items())} FROM orders)"
EDGES = f"""edges AS (SELECT 'R' || CAST(l_orderkey AS VARCHAR) AS r, {QUERY_GENE.format('//')} AS q, max((l_orderkey * 37 + l_linenumber) % 1000) AS weight FROM lineitem GROUP BY 1, 2)"""
COMPONENTS = """u AS (SELECT r AS a, q AS b FROM edges UNION SELECT q, r FROM edges),
w(a, b) AS (SELECT a, a FROM u UNION SELECT w.a, u.b FROM w JOIN u ON w.b = u.a),
comp AS (SELECT a AS node, min(b) AS comp FROM w GROUP BY a)"""
SEQUENCES = "seqs AS (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS seq FROM documents)"
