"""Registered queries over the fixture views, each with the same query as SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from genoweave.functions import sequence as S
from genoweave.operators import chains as C
from genoweave.operators import graph as G
from genoweave.operators import intervals as I
from genoweave.operators import kernels as K
from genoweave.operators import local
from genoweave.operators import projections as P
from genoweave.plans import fixtures as X

QUERIES: dict = {}
ORACLES: dict = {}


def _register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@_register(f"""WITH {X.EXONS} SELECT tx, max(e_end) - min(e_start) AS gene_len, count(*) AS ex_num, CAST(sum(e_end - e_start) AS BIGINT) AS ex_fract,
  CAST(max(e_end) - min(e_start) - sum(e_end - e_start) AS BIGINT) AS intr_fract FROM exons GROUP BY tx""")
def bed_tx_stats(spark, d):
    span, bases = F.max("e_end") - F.min("e_start"), F.sum(F.col("e_end") - F.col("e_start"))
    return X.exons(spark, d).groupBy("tx").agg(span.alias("gene_len"), F.count("*").alias("ex_num"), bases.alias("ex_fract"), (span - bases).alias("intr_fract"))


@_register(f"""WITH {X.EXONS}, s AS (SELECT tx, chrom, CAST(sum(e_end - e_start) AS BIGINT) AS cds FROM exons GROUP BY tx, chrom)
SELECT tx, CASE WHEN chrom = 'chr4' THEN 'EXCLUDED_CONTIG' WHEN cds = 0 THEN 'NON_CODING' WHEN (cds + tx) % 3 <> 0 THEN 'FRAME' ELSE 'PASS' END AS reason FROM s""")
def annotation_filter(spark, d):
    s = X.exons(spark, d).groupBy("tx", "chrom").agg(F.sum(F.col("e_end") - F.col("e_start")).alias("cds"))
    reason = F.when(F.col("chrom") == "chr4", "EXCLUDED_CONTIG").when(F.col("cds") == 0, "NON_CODING").when((F.col("cds") + F.col("tx")) % 3 != 0, "FRAME")
    return s.select("tx", reason.otherwise("PASS").alias("reason"))


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS} SELECT tx, count(*) AS n, CAST(sum(least(e_end, t_end - 20) - greatest(e_start, t_start + 20)) AS BIGINT) AS bases
FROM exons JOIN ts USING (tx, chrom) WHERE least(e_end, t_end - 20) > greatest(e_start, t_start + 20) GROUP BY tx""")
def cds_trim(spark, d):
    rows = I.collect_blocks(X.exons(spark, d)).withColumn("a", F.col("t_start") + 20).withColumn("b", F.col("t_end") - 20)
    rows = rows.withColumn("cds", I.trim_blocks("blocks", "a", "b")).filter(F.size("cds") > 0)
    return rows.select("tx", F.size("cds").cast("bigint").alias("n"), I.sum_lengths("cds").alias("bases"))


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS}
SELECT tx, CAST(sum(greatest(0, least(e_end, t_start + 20) - e_start)) AS BIGINT) AS utr5, CAST(sum(greatest(0, e_end - greatest(e_start, t_end - 20))) AS BIGINT) AS utr3
FROM exons JOIN ts USING (tx, chrom) GROUP BY tx""")
def utr_fraction(spark, d):
    rows = I.collect_blocks(X.exons(spark, d)).withColumn("a", F.col("t_start") + 20).withColumn("b", F.col("t_end") - 20)
    return rows.select("tx", I.sum_lengths(I.trim_blocks("blocks", "t_start", "a")).alias("utr5"), I.sum_lengths(I.trim_blocks("blocks", "b", "t_end")).alias("utr3"))


@_register(f"""WITH {X.EXONS}, g AS (SELECT tx, e_end AS s, lead(e_start) OVER (PARTITION BY tx ORDER BY e_start, e_end) AS e FROM exons) SELECT tx, s, e FROM g WHERE e > s""")
def intron_blocks(spark, d):
    rows = I.collect_blocks(X.exons(spark, d)).select("tx", F.explode(I.complement_blocks("blocks")).alias("g"))
    return rows.select("tx", "g.s", "g.e")


@_register(f"WITH {X.BLOCKS} SELECT * FROM blocks")
def chain_blocks(spark, d):
    return X.blocks(spark, d)


@_register(f"WITH {X.BLOCKS}, g AS (SELECT chain, blk, b_end AS g_start, lead(b_start) OVER (PARTITION BY chain ORDER BY blk) AS g_end FROM blocks) SELECT * FROM g WHERE g_end > g_start")
def chain_gaps(spark, d):
    return C.chain_gaps(X.blocks(spark, d))


@_register(f"WITH {X.FEATURE_CTE} SELECT tx, chain, score FROM features WHERE score >= 5000")
def chain_score_filter(spark, d):
    return X.features(spark, d).filter("score >= 5000").select("tx", "chain", "score")


@_register(f"WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS} SELECT chain, tx FROM cs JOIN ts ON cs.chrom = ts.chrom AND c_start < t_end AND t_start < c_end")
def chain_tx_join(spark, d):
    return C.chain_transcript_pairs(X.exons(spark, d), X.blocks(spark, d))


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS} SELECT tx, CASE WHEN chrom IN (SELECT chrom FROM blocks) THEN 'UNALIGNED_TR' ELSE 'UNCOV_CHROM' END AS reason
FROM ts WHERE tx NOT IN (SELECT tx FROM cs JOIN ts ON cs.chrom = ts.chrom AND c_start < t_end AND t_start < c_end)""")
def chain_tx_unaligned(spark, d):
    return C.unaligned(X.exons(spark, d), X.blocks(spark, d))


_COVERAGE = """coverage AS (SELECT e.tx, b.chain, count(DISTINCT e.exon) AS n_exons, CAST(sum(least(e.e_end, b.b_end) - greatest(e.e_start, b.b_start)) AS BIGINT) AS cov
FROM exons e JOIN blocks b ON e.chrom = b.chrom AND e.e_start < b.b_end AND b.b_start < e.e_end GROUP BY e.tx, b.chain)"""


@_register(f"WITH {X.EXONS}, {X.BLOCKS}, {_COVERAGE} SELECT * FROM coverage")
def block_exon_coverage(spark, d):
    return C.block_exon_coverage(X.exons(spark, d), X.blocks(spark, d))


@_register(f"""WITH {X.EXONS}, f AS (SELECT *, CASE WHEN e_start < max(e_end) OVER (PARTITION BY chrom ORDER BY e_start, e_end, tx, exon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM exons),
g AS (SELECT *, CAST(sum(f) OVER (PARTITION BY chrom ORDER BY e_start, e_end, tx, exon ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM f)
SELECT chrom, grp, min(e_start) AS m_start, max(e_end) AS m_end, count(*) AS n FROM g GROUP BY chrom, grp""")
def interval_merge(spark, d):
    return I.merge_intervals(X.exons(spark, d), ["chrom"], "e_start", "e_end", ["tx", "exon"])


@_register(f"""WITH {X.EXONS}, p AS (SELECT chrom, e_start AS pos, 1 AS x FROM exons UNION ALL SELECT chrom, e_end, -1 FROM exons), s AS (SELECT chrom, pos, sum(x) AS x FROM p GROUP BY chrom, pos),
u AS (SELECT chrom, pos AS u_start, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS u_end, CAST(sum(x) OVER (PARTITION BY chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM s) SELECT * FROM u WHERE depth > 0""")
def interval_discretize(spark, d):
    return I.discretize(X.exons(spark, d), ["chrom"], "e_start", "e_end")


# exons, and bodies that reach over many of them
_COVER = "SELECT tx, chrom, e_start AS s, e_end AS e FROM exons UNION ALL SELECT -tx, chrom, e_start, e_start + 60000 + tx % 7 * 9000 FROM exons WHERE exon = 1 AND tx % 50 = 0"


@_register(f"""WITH {X.EXONS}, c AS ({_COVER}), p AS (SELECT DISTINCT chrom, s AS x FROM c UNION SELECT chrom, e FROM c),
u AS (SELECT chrom, x AS u_start, lead(x) OVER (PARTITION BY chrom ORDER BY x) AS u_end FROM p)
SELECT DISTINCT u.chrom, u_start, u_end, tx FROM u JOIN c ON c.chrom = u.chrom AND c.s <= u_start AND c.e >= u_end""")
def interval_unit_owners(spark, d):
    return I.unit_owners(spark.sql(_COVER.replace("FROM exons", "FROM {exons}"), exons=X.exons(spark, d)), ["chrom"], "s", "e", "tx")


@_register(f"""WITH {X.EXONS}, {X.ISOFORMS}, e AS (SELECT chrom, gene, tx, e_start, e_end FROM exons JOIN isoforms USING (tx))
SELECT a.tx AS tx_a, b.tx AS tx_b, CAST(sum(least(a.e_end, b.e_end) - greatest(a.e_start, b.e_start)) AS BIGINT) AS shared FROM e a JOIN e b ON a.chrom = b.chrom AND a.tx < b.tx AND a.gene <> b.gene AND a.e_start < b.e_end AND b.e_start < a.e_end GROUP BY a.tx, b.tx""")
def self_overlap_diff_gene(spark, d):
    e = X.exons(spark, d).join(X.isoforms(spark, d), "tx").drop("exon")
    side = lambda x: e.select("chrom", F.col("gene").alias(f"g_{x}"), F.col("tx").alias(f"tx_{x}"), F.col("e_start").alias(f"s_{x}"), F.col("e_end").alias(f"e_{x}"))
    return local.local_overlaps(side("a"), side("b"), ["chrom"], ["tx_a"], ("s_a", "e_a"), ("s_b", "e_b"), local.other_genes, "tx_a bigint, tx_b bigint, shared bigint")


@_register(f"""WITH {X.BLOCKS}, s AS (SELECT chain, chrom, blk, b_start, b_end FROM blocks) SELECT a.chain, a.blk AS blk_a, b.blk AS blk_b FROM s a JOIN s b ON a.chrom = b.chrom AND a.chain = b.chain AND a.blk < b.blk
AND a.b_start - 40 < b.b_end + 40 AND b.b_start - 40 < a.b_end + 40
WHERE 2 * (least(a.b_end, b.b_end) - greatest(a.b_start, b.b_start) + 80) >= a.b_end - a.b_start + 80 OR 2 * (least(a.b_end, b.b_end) - greatest(a.b_start, b.b_start) + 80) >= b.b_end - b.b_start + 80""")
def proj_50pct_overlap(spark, d):
    wide = X.blocks(spark, d).select("chain", "blk", (F.col("b_start") - 40).alias("s"), (F.col("b_end") + 40).alias("e"))
    side = lambda x: wide.select("chain", F.col("blk").alias(f"blk_{x}"), F.col("s").alias(f"s_{x}"), F.col("e").alias(f"e_{x}"))
    hits = I.interval_join(side("a"), side("b"), ["chain"], ("s_a", "e_a"), ("s_b", "e_b")).filter("blk_a < blk_b")
    shared = 2 * I.overlap(F.col("s_a"), F.col("e_a"), F.col("s_b"), F.col("e_b"))
    return hits.filter((shared >= F.col("e_a") - F.col("s_a")) | (shared >= F.col("e_b") - F.col("s_b"))).select("chain", "blk_a", "blk_b")


@_register(f"WITH {X.EXONS}, p AS (SELECT event_id AS id, 'chr' || CAST(event_id % 5 AS VARCHAR) AS chrom, (event_id * 7577) % 2000000 AS pos FROM events) SELECT id, tx, exon FROM p JOIN exons e ON p.chrom = e.chrom AND e_start <= pos AND pos <= e_end")
def point_in_interval(spark, d):
    p = X.table(spark, d, "events").selectExpr("event_id AS id", "concat('chr', event_id % 5) AS chrom", "(event_id * 7577) % 2000000 AS pos")
    return I.point_join(p, X.exons(spark, d), ["chrom"], "pos", ("e_start", "e_end")).select("id", "tx", "exon")


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, h AS (SELECT e.tx, e.exon, b.chain, greatest(e_start, b_start) AS lo, least(e_end, b_end) AS hi, b.b_start + b.chain * 10 - b.blk % 7 - b.b_start AS shift
FROM exons e JOIN blocks b ON e.chrom = b.chrom AND e_start < b_end AND b_start < e_end)
SELECT tx, exon, chain, min_by(lo + shift, lo) AS q_start, max_by(hi + shift, hi) AS q_end FROM h GROUP BY tx, exon, chain""")
def liftover_exons(spark, d):
    b = X.blocks(spark, d).withColumn("q_start", F.expr("b_start + chain * 10 - blk % 7"))
    return C.liftover(X.exons(spark, d), b)


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS}, {X.ISOFORMS}, {_COVERAGE},
body AS (SELECT t.tx, b.chain, CAST(sum(least(t_end, b_end) - greatest(t_start, b_start)) AS BIGINT) AS body_cover FROM ts t JOIN blocks b ON t.chrom = b.chrom AND t_start < b_end AND b_start < t_end GROUP BY t.tx, b.chain),
s AS (SELECT chain, count(DISTINCT gene) AS synt, count(DISTINCT c.tx) AS tx_on_chain FROM coverage c JOIN isoforms i ON c.tx = i.tx GROUP BY chain)
SELECT b.tx, b.chain, coalesce(cov, 0) AS exon_cover, coalesce(n_exons, 0) AS n_exons, body_cover, body_cover - coalesce(cov, 0) AS intr_cover, coalesce(synt, 0) AS synt, coalesce(tx_on_chain, 0) AS tx_on_chain
FROM body b LEFT JOIN coverage c ON b.tx = c.tx AND b.chain = c.chain LEFT JOIN s ON b.chain = s.chain""")
def projection_features(spark, d):
    return C.projection_features(X.exons(spark, d), X.blocks(spark, d), X.isoforms(spark, d))


@_register(f"WITH {X.EXONS}, {X.BLOCKS}, {X.ISOFORMS}, {_COVERAGE} SELECT chain, count(DISTINCT gene) AS synt FROM coverage c JOIN isoforms i ON c.tx = i.tx GROUP BY chain")
def synteny_count(spark, d):
    return C.synteny_counts(X.exons(spark, d), X.blocks(spark, d), X.isoforms(spark, d)).select("chain", "synt")


_CLASSES = f"""{X.FEATURE_CTE},
c1 AS (SELECT *, CASE WHEN exon_cover = 0 THEN -1 WHEN synt = 1 AND qlen > 95 AND pred < 50 AND CASE WHEN ex_fract = 0 THEN 0 ELSE exon_cover * 100 / ex_fract END > 65 AND ex_num > 1 THEN -2 ELSE pred END AS p1 FROM features),
c2 AS (SELECT *, count(*) FILTER (p1 > 50) OVER (PARTITION BY tx) AS above, max(p1) OVER (PARTITION BY tx) AS best FROM c1),
c3 AS (SELECT *, CASE WHEN p1 >= 0 AND clip_exon > 30 AND clip_intr >= 0 AND clip_intr < 10 AND (p1 < 50 OR (above > 1 AND p1 < best)) THEN -2 ELSE p1 END AS p2 FROM c2),
classes AS (SELECT tx, chain, score, p2 AS pred, CASE p2 WHEN -1 THEN 'SPAN' WHEN -2 THEN 'P_PGENE' ELSE CASE WHEN p2 < 50 THEN 'PARA' ELSE 'ORTH' END END AS class, status FROM c3)"""


@_register(f"WITH {_CLASSES} SELECT tx, chain, score, pred, class FROM classes")
def classify_rules(spark, d):
    return P.classify(X.features(spark, d))


@_register(f"WITH {_CLASSES} SELECT tx, chain FROM classes WHERE class = 'P_PGENE'")
def pp_rules(spark, d):
    return P.classify(X.features(spark, d)).filter("class = 'P_PGENE'").select("tx", "chain")


@_register(f"""WITH {_CLASSES}, l AS (SELECT tx, class, array_to_string(list_sort(list(chain)), ',') AS l FROM classes GROUP BY tx, class)
SELECT tx, coalesce(max(l) FILTER (class = 'ORTH'), '0') AS orth, coalesce(max(l) FILTER (class = 'PARA'), '0') AS para, coalesce(max(l) FILTER (class = 'SPAN'), '0') AS span, coalesce(max(l) FILTER (class = 'P_PGENE'), '0') AS p_pgene FROM l GROUP BY tx""")
def class_pivot(spark, d):
    return P.class_lists(P.classify(X.features(spark, d)))


@_register(f"""WITH {_CLASSES}, t AS (SELECT *, CASE class WHEN 'ORTH' THEN 1 WHEN 'SPAN' THEN 2 WHEN 'PARA' THEN 3 END AS tier FROM classes),
b AS (SELECT *, min(tier) OVER (PARTITION BY tx) AS best FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY tx ORDER BY chain) AS r FROM b WHERE tier = best)
SELECT tx, chain, class FROM r WHERE r <= 100 UNION ALL SELECT tx, chain, class FROM classes WHERE class = 'P_PGENE'""")
def admission_topn(spark, d):
    return P.admit(P.classify(X.features(spark, d)))


@_register(f"WITH {_CLASSES} SELECT tx, chain, 'INSUFFICIENT_CHAIN_SCORE' AS reason, 'L' AS status FROM classes WHERE class = 'ORTH' AND score < 15000 UNION ALL SELECT DISTINCT tx, CAST(NULL AS BIGINT), 'NO_PROJ', 'M' FROM features WHERE tx NOT IN (SELECT tx FROM classes WHERE class <> 'ORTH' OR score >= 15000)")
def unclassified_reject(spark, d):
    classes = P.classify(X.features(spark, d))
    kept = P.enough_score(classes, 15000)
    low = classes.filter("class = 'ORTH' AND score < 15000").select("tx", "chain", F.lit("INSUFFICIENT_CHAIN_SCORE").alias("reason"), F.lit("L").alias("status"))
    gone = classes.select("tx").distinct().join(kept, "tx", "left_anti").select("tx", F.lit(None).cast("bigint").alias("chain"), F.lit("NO_PROJ").alias("reason"), F.lit("M").alias("status"))
    return low.unionByName(gone)


_RANK = "list_position(['N', 'PP', 'PG', 'PM', 'M', 'L', 'UL', 'PI', 'I', 'FI'], {})"


@_register(f"""WITH {_CLASSES}, {X.ISOFORMS}, c AS (SELECT tx, CASE class WHEN 'PARA' THEN 'PG' ELSE status END AS status FROM classes WHERE class <> 'P_PGENE'),
t AS (SELECT tx, max_by(status, {_RANK.format("status")}) AS status FROM c GROUP BY tx), g AS (SELECT gene, coalesce(status, 'N') AS status FROM isoforms LEFT JOIN t USING (tx))
SELECT 'PROJECTION' AS level, CAST(tx AS VARCHAR) || '#' || CAST(chain AS VARCHAR) AS entry, status FROM classes
UNION ALL SELECT 'TRANSCRIPT', CAST(tx AS VARCHAR), status FROM t UNION ALL SELECT 'GENE', CAST(gene AS VARCHAR), max_by(status, {_RANK.format("status")}) FROM g GROUP BY gene""")
def loss_rollup(spark, d):
    return P.loss_rollup(P.classify(X.features(spark, d), keep=("status",)), X.isoforms(spark, d))


@_register(f"""WITH {_CLASSES}, own AS (SELECT o_orderkey AS tx, CASE WHEN o_orderkey % 13 = 0 THEN 'M' END AS tx_status FROM orders), p AS (SELECT tx, max_by(status, {_RANK.format("status")}) AS status FROM classes GROUP BY tx)
SELECT tx, coalesce(tx_status, status, 'N') AS status FROM own LEFT JOIN p USING (tx)""")
def reject_rollup(spark, d):
    best = P.best_status(X.features(spark, d).select("tx", "status"), ["tx"])
    own = X.table(spark, d, "orders").selectExpr("o_orderkey AS tx", "CASE WHEN o_orderkey % 13 = 0 THEN 'M' END AS tx_status")
    return own.join(best, "tx", "left").select("tx", F.coalesce("tx_status", "status", F.lit("N")).alias("status"))


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS}, g AS (SELECT chain, chrom, b_end AS g_start, lead(b_start) OVER (PARTITION BY chain ORDER BY blk) AS g_end FROM blocks),
s AS (SELECT tx, chain, g_start, g_end FROM ts JOIN g ON ts.chrom = g.chrom AND g_start <= t_start AND t_start + 60 <= g_end AND g_end > g_start)
SELECT tx, arg_min(chain, (g_end - g_start) * 1000000 + chain) AS chain FROM s GROUP BY tx""")
def span_precedence(spark, d):
    b = X.blocks(spark, d)
    gaps = C.chain_gaps(b).join(b.select("chain", "chrom").distinct(), "chain")
    head = C.transcript_spans(X.exons(spark, d)).withColumn("h_end", F.col("t_start") + 60)
    # a transcript's gaps meet in one task, which hands on the narrowest
    hits = local.local_overlaps(head, gaps, ["chrom"], ["tx"], ("t_start", "h_end"), ("g_start", "g_end"), local.narrowest, "tx bigint, chain bigint, g_start bigint, g_end bigint")
    return P.span_precedence(hits)


@_register(f"WITH {X.EDGES} SELECT * FROM edges")
def edge_weights(spark, d):
    return X.edges(spark, d)


@_register(f"WITH RECURSIVE {X.EDGES}, {X.COMPONENTS} SELECT node AS vertex, comp AS root FROM comp")
def components(spark, d):
    return G.connected_components(X.edges(spark, d), "r", "q")


_CLASS = f"""{X.EDGES}, {X.COMPONENTS}, m AS (SELECT comp, r, q FROM edges JOIN comp ON q = node),
k AS (SELECT comp, count(DISTINCT r) AS n_ref, count(DISTINCT q) AS n_query, count(*) AS n_edges FROM m GROUP BY comp
  UNION ALL SELECT DISTINCT 'R' || CAST(o_orderkey AS VARCHAR), 1, 0, 0 FROM orders WHERE 'R' || CAST(o_orderkey AS VARCHAR) NOT IN (SELECT r FROM edges))"""


@_register(f"""WITH RECURSIVE {_CLASS} SELECT *, CASE WHEN n_query = 0 THEN 'one2zero' WHEN n_ref = 1 AND n_query = 1 THEN 'one2one' WHEN n_ref = 1 THEN 'one2many' WHEN n_query = 1 THEN 'many2one' ELSE 'many2many' END AS class, n_edges = n_ref * n_query AS complete FROM k""")
def orthology_class(spark, d):
    nodes = X.table(spark, d, "orders").selectExpr("concat('R', o_orderkey) AS r")
    edges = X.edges(spark, d).drop("weight")
    return G.orthology_classes(edges, nodes, G.bipartite_components(edges))


@_register(f"WITH RECURSIVE {_CLASS} SELECT comp FROM k WHERE n_query > 0 AND n_edges = n_ref * n_query")
def bipartite_complete(spark, d):
    edges = X.edges(spark, d).drop("weight")
    return G.orthology_classes(edges, None, G.bipartite_components(edges)).filter("complete").select("comp")


@_register(f"""WITH RECURSIVE {X.EDGES}, {X.COMPONENTS}, e AS (SELECT r, q, weight, comp, count(*) OVER (PARTITION BY r) = 1 OR count(*) OVER (PARTITION BY q) = 1 AS leaf FROM edges JOIN comp ON q = node),
k AS (SELECT comp FROM e GROUP BY comp HAVING count(DISTINCT r) > 1 AND count(DISTINCT q) > 1 AND (max(weight) FILTER (leaf) < 750 OR max(weight) FILTER (leaf) * 10 <= min(weight) FILTER (NOT leaf) * 9) AND min(weight) FILTER (NOT leaf) IS NOT NULL)
SELECT r, q, weight, comp FROM e WHERE leaf AND comp IN (SELECT comp FROM k)""")
def leaf_split(spark, d):
    return G.removable_leaf_edges(X.edges(spark, d))


@_register(f"""WITH {X.EDGES}, s AS (SELECT q, list_sort(list(DISTINCT r)) AS rs FROM edges GROUP BY q), b AS (SELECT q, CASE WHEN len(rs) > 3 THEN array_to_string(rs[1:3], ',') || '+' ELSE array_to_string(rs, ',') END AS base FROM s)
SELECT q, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '_' || CAST(row_number() OVER (PARTITION BY base ORDER BY q) AS VARCHAR) ELSE base END AS name FROM b""")
def query_gene_naming(spark, d):
    return P.query_gene_names(X.edges(spark, d).select("q", "r"))


@_register(f"""WITH {_CLASSES}, {X.ISOFORMS}, x AS (SELECT gene, tx, status, ex_fract FROM isoforms JOIN (SELECT tx, status, ex_fract, chain FROM features) USING (tx)), r AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY {_RANK.format("status")} DESC, ex_fract DESC, tx) AS n FROM x)
SELECT gene, tx, status FROM r WHERE n = 1""")
def best_isoform(spark, d):
    x = X.isoforms(spark, d).join(X.features(spark, d).select("tx", "status", "ex_fract"), "tx")
    best = x.groupBy("gene").agg(F.min_by(F.struct("tx", "status"), F.struct(-P.status_rank(F.col("status")), -F.col("ex_fract"), F.col("tx"))).alias("b"))
    return best.select("gene", "b.tx", "b.status")


@_register(f"WITH {X.SEQUENCES} SELECT doc_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, length(seq) AS n FROM seqs")
def revcomp(spark, d):
    return X.sequences(spark, d).select("doc_id", S.reverse_complement(F.col("seq")).alias("rc"), F.length("seq").cast("bigint").alias("n"))


_CODONS = ", ".join(f"'{c}': '{a}'" for c, a in S.codon_table().items())


@_register(f"WITH {X.SEQUENCES} SELECT doc_id, array_to_string(list_transform(range((length(seq) + 2) // 3), lambda i: coalesce(MAP {{{_CODONS}}}[substr(seq, 3 * i + 1, 3)], 'X')), '') AS protein FROM seqs")
def codon_translate(spark, d):
    return X.sequences(spark, d).select("doc_id", S.translate(F.col("seq")).alias("protein"))


@_register("SELECT doc_id, contains(upper(text), repeat('N', 2)) AS gap FROM documents")
def gap_scan(spark, d):
    return X.table(spark, d, "documents").select("doc_id", S.has_assembly_gap(F.col("text"), 2).alias("gap"))


@_register(f"WITH {X.SEQUENCES}, p AS (SELECT doc_id, unnest(string_split(seq, '')) AS a, unnest(string_split(reverse(seq), '')) AS b FROM seqs WHERE seq <> ''), n AS (SELECT doc_id, CAST(count(*) FILTER (a = b) AS INTEGER) AS same FROM p GROUP BY doc_id) SELECT doc_id, coalesce(same, 0) AS same FROM seqs LEFT JOIN n USING (doc_id)")
def identity(spark, d):
    return X.sequences(spark, d).select("doc_id", F.coalesce(S.matches(F.col("seq"), F.reverse("seq")), F.lit(0)).alias("same"))


_STATES = "translate(seq, 'ACGT', 'ILDM')"


@_register(f"WITH {X.SEQUENCES} SELECT doc_id, CAST(list_max(list_transform(string_split({_STATES}, 'L'), lambda s: length(s))) AS INTEGER) AS longest FROM seqs")
def longest_intact_run(spark, d):
    return X.sequences(spark, d).select("doc_id", S.longest_run(F.translate("seq", "ACGT", "ILDM")).alias("longest"))


@_register(f"WITH {X.SEQUENCES}, c AS (SELECT doc_id, unnest(range((length(seq) + 2) // 3)) AS codon, seq FROM seqs) SELECT doc_id, codon + 1 AS codon, substr(seq, 3 * codon + 1, 3) AS triplet FROM c WHERE substr(seq, 3 * codon + 1, 3) IN ('TAA', 'TAG', 'TGA')")
def stop_codons(spark, d):
    rows = X.sequences(spark, d).select("doc_id", F.posexplode(S.chunks(F.col("seq"), 3)).alias("i", "triplet"))
    return rows.filter(F.col("triplet").isin("TAA", "TAG", "TGA")).select("doc_id", (F.col("i") + 1).cast("bigint").alias("codon"), "triplet")


@_register("SELECT l_orderkey AS tx, CAST(sum(l_partkey % 7 - 3) % 3 + CASE WHEN sum(l_partkey % 7 - 3) % 3 < 0 THEN 3 ELSE 0 END AS BIGINT) AS frame FROM lineitem GROUP BY l_orderkey")
def frameshift_balance(spark, d):
    rows = X.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx")).agg(F.collect_list(F.expr("l_partkey % 7 - 3")).alias("x"))
    return rows.select("tx", S.frame_balance(F.col("x")).alias("frame"))


_LADDER = """CASE WHEN n_crit = 0 AND strict > 60 THEN CASE WHEN preserving THEN 'FI' ELSE 'I' END WHEN all_deleted OR total < 35 OR relaxed < 20 THEN 'L' WHEN all_missing THEN 'M'
WHEN mid_intact THEN CASE WHEN total < 49 THEN 'UL' WHEN missing = 0 OR mid_present THEN 'I' WHEN missing < 50 THEN 'PI' ELSE 'M' END
WHEN n_exons = 1 THEN CASE WHEN n_affecting > 1 AND strict < 60 THEN 'L' ELSE 'UL' END
WHEN strict < 60 AND (n_affected >= CASE WHEN n_exons <= 1 THEN 1 WHEN n_exons <= 10 THEN 2 ELSE n_exons / 5 END OR big_exon) THEN 'L' ELSE 'UL' END"""


@_register(f"WITH {X.METRIC_CTE} SELECT tx, {_LADDER} AS status FROM metrics")
def loss_ladder(spark, d):
    return P.loss_ladder(X.metrics(spark, d))


@_register("SELECT l_orderkey AS tx, l_linenumber AS exon, CASE WHEN l_partkey % 101 >= 75 AND l_suppkey % 101 >= 65 THEN 'HQ' WHEN l_partkey % 101 >= 65 AND l_suppkey % 101 >= 40 THEN 'AQ' WHEN l_partkey % 101 >= 45 AND l_suppkey % 101 >= 25 THEN 'LQ' ELSE 'NA' END AS quality FROM lineitem")
def exon_quality(spark, d):
    rows = X.table(spark, d, "lineitem")
    return rows.select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("exon"), P.exon_quality(F.col("l_partkey") % 101, F.col("l_suppkey") % 101).alias("quality"))


@_register("""WITH r AS (SELECT l_orderkey AS tx, l_linenumber AS exon, l_partkey % 3 = 0 AS del, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem),
g AS (SELECT *, i - row_number() OVER (PARTITION BY tx ORDER BY i) AS g FROM r WHERE del) SELECT tx, min(exon) AS first, max(exon) AS last, count(*) AS n FROM g GROUP BY tx, g""")
def deletion_runs(spark, d):
    rows = X.table(spark, d, "lineitem").select("*", F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("exon"), (F.col("l_partkey") % 3 == 0).alias("del"))
    return P.runs(rows, ["tx"], ["exon", "l_partkey", "l_suppkey", "l_extendedprice"], F.col("del"))


@_register("""WITH m AS (SELECT l_orderkey AS tx, CAST(max(l_partkey * CAST(l_quantity AS BIGINT)) // 1000 AS BIGINT) AS mem FROM lineitem GROUP BY l_orderkey)
SELECT tx, mem, CASE WHEN mem > 60 THEN 'HEAVY' WHEN mem <= 3 THEN '3' WHEN mem <= 5 THEN '5' WHEN mem <= 7 THEN '7' WHEN mem <= 10 THEN '10' WHEN mem <= 15 THEN '15' ELSE 'big' END AS bin FROM m""")
def memory_bins(spark, d):
    m = X.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx")).agg(F.expr("max(l_partkey * CAST(l_quantity AS BIGINT)) div 1000").alias("mem"))
    return P.memory_bins(m, [3, 5, 7, 10, 15], 60)


@_register(f"WITH {X.EXONS}, n AS (SELECT chrom, tx, e_start, e_end, lag(e_end) OVER (PARTITION BY tx ORDER BY exon, e_end) AS before FROM exons) SELECT tx, e_start, e_start - before AS intron FROM n WHERE before IS NOT NULL")
def neighbour_introns(spark, d):
    before = F.lag("e_end").over(Window.partitionBy("tx").orderBy("exon", "e_end"))
    return X.exons(spark, d).withColumn("before", before).filter("before is not null").select("tx", "e_start", (F.col("e_start") - F.col("before")).alias("intron"))


@_register(f"WITH {X.EXONS} SELECT chrom, min(e_start) AS low, max(e_end) AS high, CAST(sum(e_end - e_start) AS BIGINT) AS bases FROM exons GROUP BY chrom")
def contig_sizes(spark, d):
    return X.exons(spark, d).groupBy("chrom").agg(F.min("e_start").alias("low"), F.max("e_end").alias("high"), F.sum(F.col("e_end") - F.col("e_start")).alias("bases"))


@_register()
def chain_tiling(spark, d):
    # every block counts as a chain of its own, so that transcripts lie in several
    exons, pieces = X.exons(spark, d), X.blocks(spark, d).selectExpr("blk AS chain", "chrom", "b_start AS c_start", "b_end AS c_end")
    chosen = C.fragment_candidates(exons, pieces.withColumnsRenamed({"c_start": "b_start", "c_end": "b_end"}))
    return K.best_tiling(chosen.join(pieces, "chain").selectExpr("tx", "chain", "c_start - 300 AS c_start", "c_end + 300 AS c_end", "c_end - c_start AS score"))


@_register()
def viterbi_align(spark, d):
    # every whole sequence, as exons of 30 bases against copies without their fifth codon
    exons = X.sequences(spark, d).select("doc_id", F.posexplode(S.chunks(F.col("seq"), 30)).alias("i", "ref"))
    pairs = exons.select(F.concat_ws(":", "doc_id", "i").alias("exon"), "ref", F.expr("concat(substring(ref, 1, 12), substring(ref, 16, 15))").alias("query"))
    return K.codon_align(pairs, "exon")


@_register()
def newick_label(spark, d):
    trees = X.table(spark, d, "orders").selectExpr("o_orderkey AS tree", "concat('((R', o_orderkey % 3, '_a:1,Q', o_orderkey % 5, '_b:2)0.9:1,(R', o_orderkey % 4, '_c:1,Q1_d:3)0.8:1);') AS newick")
    return K.newick_splits(trees)


@_register()
def gbt_score(spark, d):
    return K.train_and_score(X.features(spark, d), ["synt", "exon_cover", "qlen", "clip_exon", "clip_intr"])
