"""Queries that graft untranslated regions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.operators import grafting
from genoweave.plans import fixtures as X

QUERIES, ORACLES = {}, {}


def _register(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


# a transcript an order, an exon a line, and one chain a transcript: its blocks stop short of the exons or go beyond them
_LINES = """SELECT l_orderkey AS tx, l_linenumber AS i, 100 + (l_linenumber - 1) * 400 AS s, 100 + (l_linenumber - 1) * 400 + CAST(min(l_quantity) AS BIGINT) * 3 AS e,
  min(l_suppkey) % 60 AS x, min(l_partkey) % 70 AS y, min(l_partkey) % 4 AS gone, l_orderkey % 2 = 0 AS forward, l_orderkey % 3 > 0 AS codirected FROM lineitem GROUP BY l_orderkey, l_linenumber"""
_SPANS = "SELECT tx, min(s) + (tx * 17) % 130 AS thick_start, max(e) - (tx * 13) % 110 AS thick_end FROM lines GROUP BY tx"
_BLOCKS = """SELECT tx AS chain, 'chr1' AS chrom, b_start, b_end, CASE WHEN codirected THEN b_start + 40 + 9 * i ELSE 3400 - b_end - 9 * i END AS q_start,
  CASE WHEN codirected THEN b_end + 40 + 9 * i ELSE 3400 - b_start - 9 * i END AS q_end, codirected
  FROM (SELECT *, s - 30 + x AS b_start, e + 40 - y AS b_end FROM lines WHERE gone > 0) z WHERE b_end > b_start"""
# coding blocks, moved to the query in one piece
_CODING = """SELECT tx, CASE WHEN codirected THEN a + 45 ELSE 3390 - b END AS s, CASE WHEN codirected THEN b + 45 ELSE 3390 - a END AS e, forward = codirected AS forward
  FROM (SELECT l.tx, greatest(l.s, p.thick_start) AS a, least(l.e, p.thick_end) AS b, l.forward, l.codirected FROM lines l JOIN spans p ON l.tx = p.tx) z WHERE b > a"""
_PIECES = """pieces AS (SELECT tx, forward, codirected, s AS u_start, least(e, thick_start) AS u_end, true AS low, least(e, thick_start) = thick_start AS adjacent FROM lines JOIN spans USING (tx) WHERE s < thick_start AND thick_end > thick_start
  UNION ALL SELECT tx, forward, codirected, greatest(s, thick_end), e, false, greatest(s, thick_end) = thick_end FROM lines JOIN spans USING (tx) WHERE e > thick_end AND thick_end > thick_start)"""
_PROJECTED = f"""lines AS ({_LINES}), spans AS ({_SPANS}), blocks AS ({_BLOCKS}), coding AS ({_CODING}), {_PIECES},
met AS (SELECT p.tx, u_start, u_end, low, adjacent, low = forward AS five, b.codirected, min(b_start) AS b0, max(b_end) AS b1, min(q_start) AS q0, max(q_end) AS q1
  FROM pieces p JOIN blocks b ON b.chain = p.tx AND b_start < u_end AND u_start < b_end WHERE p.tx IN (SELECT tx FROM coding) GROUP BY ALL),
ends AS (SELECT *, u_end - u_start AS size, CASE WHEN b0 > u_start AND b0 - u_start > 20 AND b0 - u_start > floor((u_end - u_start) * 1.5) THEN 0 ELSE b0 - u_start END AS l,
  CASE WHEN u_end > b1 AND u_end - b1 > 20 AND u_end - b1 > floor((u_end - u_start) * 1.5) THEN 0 ELSE u_end - b1 END AS r FROM met),
found AS (SELECT tx, five, adjacent, size, greatest(0, q0 - CASE WHEN codirected THEN l ELSE r END) AS p_start, least(3500, q1 + CASE WHEN codirected THEN r ELSE l END) AS p_end FROM ends)"""
_GRAFTED = f"""{_PROJECTED},
thick AS (SELECT tx, min(s) AS qs, max(e) AS qe, bool_and(forward) AS forward, tx % 5 > 0 AS first_ok, tx % 7 > 0 AS last_ok FROM coding GROUP BY tx),
fit AS (SELECT tx, five, adjacent, five = forward AS q_low, CASE WHEN adjacent AND five <> forward THEN qe ELSE p_start END AS s, CASE WHEN adjacent AND five = forward THEN qs ELSE p_end END AS e, qs, qe
  FROM (SELECT f.*, t.qs, t.qe, t.forward, CASE WHEN f.five = t.forward THEN qs - p_end ELSE p_start - qe END AS gap FROM found f JOIN thick t USING (tx)
    WHERE p_end > p_start AND CASE WHEN five THEN first_ok ELSE last_ok END) z
  WHERE (p_end - p_start <= 20 OR p_end - p_start <= floor(size * 1.5)) AND (NOT adjacent OR gap <= 20 OR gap <= floor(size * 1.5))),
taken AS (SELECT tx, five, adjacent, s, e FROM fit WHERE e > s AND CASE WHEN q_low THEN e <= qs ELSE s >= qe END),
due AS (SELECT p.tx, CASE WHEN (p.low = p.forward) = t.forward THEN greatest(qs - (u_end - u_start), 0) ELSE qe END AS s, CASE WHEN (p.low = p.forward) = t.forward THEN qs ELSE least(3500, qe + u_end - u_start) END AS e
  FROM pieces p JOIN thick t USING (tx) WHERE p.adjacent AND CASE WHEN p.low = p.forward THEN first_ok ELSE last_ok END
  AND NOT EXISTS (SELECT 1 FROM taken k WHERE k.tx = p.tx AND k.adjacent AND k.five = (p.low = p.forward)))"""


def _record(grafts: str) -> str:
    return f"""WITH {_GRAFTED},
grafts AS ({grafts}),
counted AS (SELECT tx, count(*) AS n FROM grafts GROUP BY tx),
every AS (SELECT tx, s, e FROM coding UNION ALL SELECT tx, s, e FROM grafts),
marked AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY tx ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM every),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY tx ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM marked),
joined AS (SELECT tx, k, min(s) AS s, max(e) AS e FROM numbered GROUP BY tx, k)
SELECT j.tx, min(j.s) AS r_start, max(j.e) AS r_end, string_agg(CAST(j.s AS VARCHAR) || '-' || CAST(j.e AS VARCHAR), ',' ORDER BY j.s) AS blocks, COALESCE(max(c.n), 0) AS n_grafted
FROM joined j LEFT JOIN counted c ON c.tx = j.tx GROUP BY j.tx"""


def _inputs(spark, d):
    lines = spark.sql(_LINES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=X.table(spark, d, "lineitem"))
    spans = spark.sql(_SPANS.replace("FROM lines", "FROM {lines}"), lines=lines)
    blocks = spark.sql(_BLOCKS.replace("FROM lines", "FROM {lines}"), lines=lines)
    coding = spark.sql(_CODING.replace("FROM lines", "FROM {lines}").replace("JOIN spans", "JOIN {spans}"), lines=lines, spans=spans)
    sorted_blocks = "array_sort(collect_list(struct(s, e))) AS blocks"
    transcripts = lines.groupBy("tx", "forward").agg(F.expr(sorted_blocks)).join(spans, "tx").selectExpr("*", "'chr1' AS chrom")
    projections = coding.groupBy("tx", "forward").agg(F.expr(sorted_blocks), F.min("s").alias("thick_start"), F.max("e").alias("thick_end"))
    projections = projections.selectExpr("*", "tx AS chain", "CAST(3500 AS BIGINT) AS q_size", "tx % 5 > 0 AS first_ok", "tx % 7 > 0 AS last_ok")
    return grafting.utr_pieces(transcripts), projections, blocks


def _grafted(spark, d, missing):
    pieces, projections, blocks = _inputs(spark, d)
    projected = grafting.project_pieces(pieces, projections, blocks, 20, 1.5)
    rows = grafting.graft_utrs(projections, pieces, projected, 20, 1.5, missing)
    return rows.selectExpr("tx", "r_start", "r_end", "array_join(transform(blocks, b -> concat(b.s, '-', b.e)), ',') AS blocks", "CAST(n_grafted AS BIGINT) AS n_grafted")


@_register(f"""WITH {_PROJECTED} SELECT tx, five AS five_prime, adjacent, size, p_start, p_end FROM found WHERE p_end > p_start""")
def utr_projection(spark, d):
    pieces, projections, blocks = _inputs(spark, d)
    pairs = projections.select("tx", "chain", "q_size")
    return grafting.project_pieces(pieces, pairs, blocks, 20, 1.5).select("tx", "five_prime", "adjacent", "size", "p_start", "p_end")


@_register(_record("SELECT tx, s, e FROM taken"))
def utr_grafting(spark, d):
    return _grafted(spark, d, "leave")


@_register(_record("SELECT tx, s, e FROM taken UNION ALL SELECT tx, s, e FROM due WHERE e > s"))
def utr_grafting_deduced(spark, d):
    return _grafted(spark, d, "deduce")
