"""Registered queries of the file formats and the annotation operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.operators import annotation as A
from genoweave.operators import chains as C
from genoweave.operators import intervals as I
from genoweave.operators import loci as L
from genoweave.operators import projections as P
from genoweave.plans import catalogue
from genoweave.plans import fixtures as X
from genoweave.session import shared_path
from genoweave.sources import genomic as N

QUERIES: dict = {}
ORACLES: dict = {}


def _register(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@_register(f"WITH {X.EXONS} SELECT tx, chrom, e_start AS s, e_end AS e FROM exons")
def bed12_round_trip(spark, d):
    rows = I.collect_blocks(X.exons(spark, d)).select(
        "chrom", F.col("t_start").alias("start"), F.col("t_end").alias("end"), F.col("tx").cast("string").alias("name"), F.lit("0").alias("score"), F.lit("+").alias("strand"),
        F.col("t_start").alias("thick_start"), F.col("t_end").alias("thick_end"), F.lit("0,0,0").alias("rgb"), "blocks",
    )
    path = shared_path(spark, "bed12")
    N.write_lines(N.bed12_lines(rows), path)
    back = N.read_bed12(spark, path).select(F.col("name").cast("bigint").alias("tx"), "chrom", F.explode("blocks").alias("b"))
    return back.select("tx", "chrom", "b.s", "b.e")


_CHAIN_STEPS = {
    "chain": "user_id", "blk": "event_id", "size": "20 + (event_id * 13) % 60", "dt": "(event_id * 31) % 500", "dq": "(event_id * 17) % 300",
    "t_from": "(user_id * 104729) % 2000000", "q_from0": "user_id * 10", "minus": "user_id % 2 = 1",
}
_STEPS = f"steps AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _CHAIN_STEPS.items())} FROM events)"


@_register(f"""WITH {_STEPS}, c AS (SELECT *, CAST(sum(size + dt) OVER w - dt AS BIGINT) AS t, CAST(sum(size + dq) OVER w - dq AS BIGINT) AS q, row_number() OVER w - 1 AS i,
CAST(sum(size + dq) OVER (PARTITION BY chain) - last_value(dq) OVER (PARTITION BY chain ORDER BY blk ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS BIGINT) AS q_all FROM steps WINDOW w AS (PARTITION BY chain ORDER BY blk))
SELECT chain, 'chr' || CAST(chain % 5 AS VARCHAR) AS chrom, i AS blk, t_from + t - size AS b_start, t_from + t AS b_end, 'q' || CAST(chain % 3 AS VARCHAR) AS q_name,
CASE WHEN minus THEN q_from0 + q_all - q ELSE q_from0 + q - size END AS q_from, CASE WHEN minus THEN q_from0 + q_all - q + size ELSE q_from0 + q END AS q_to FROM c""")
def chain_round_trip(spark, d):
    return N.aligned_blocks(_read_back(spark, d))


def _read_back(spark, d):
    s = X.table(spark, d, "events").selectExpr(*[f"{e} AS {c}" for c, e in _CHAIN_STEPS.items()])
    rows = s.groupBy("chain", "t_from", "q_from0", "minus").agg(F.array_sort(F.collect_list(F.struct("blk", "size", "dt", "dq"))).alias("l"))
    last = F.element_at("l", -1)
    total = lambda c: F.aggregate("l", F.lit(0).cast("bigint"), lambda a, x: a + x["size"] + x[c]) - last[c]
    head = rows.select(
        F.aggregate("l", F.lit(0).cast("bigint"), lambda a, x: a + x["size"]).alias("score"), F.concat(F.lit("chr"), F.col("chain") % 5).alias("t_name"), F.lit(1 << 40).alias("t_size"), F.lit("+").alias("t_strand"),
        F.col("t_from").alias("t_start"), (F.col("t_from") + total("dt")).alias("t_end"), F.concat(F.lit("q"), F.col("chain") % 3).alias("q_name"), F.lit(1 << 40).alias("q_size"),
        F.when(F.col("minus"), "-").otherwise("+").alias("q_strand"), F.col("q_from0").alias("q_start"), (F.col("q_from0") + total("dq")).alias("q_end"), "chain",
        F.transform("l", lambda x: F.struct(x["size"], x["dt"], x["dq"])).alias("steps"),
    )
    path = shared_path(spark, "chains")
    N.write_lines(N.chain_lines(head), path)
    return N.read_chains(spark, path)


@_register(f"""WITH {_STEPS}, c AS (SELECT *, CAST(sum(size + dt) OVER w - dt AS BIGINT) AS t, CAST(sum(size + dq) OVER w - dq AS BIGINT) AS q,
CAST(sum(size + dq) OVER (PARTITION BY chain) - last_value(dq) OVER (PARTITION BY chain ORDER BY blk ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS BIGINT) AS q_all FROM steps WINDOW w AS (PARTITION BY chain ORDER BY blk))
SELECT chain, CASE WHEN minus THEN q_from0 + q_all - q ELSE q_from0 + q - size END AS b_start, CASE WHEN minus THEN q_from0 + q_all - q + size ELSE q_from0 + q END AS b_end, t_from + t - size AS q_from, t_from + t AS q_to FROM c""")
def chain_swap(spark, d):
    return N.aligned_blocks(N.swap_chains(_read_back(spark, d))).select("chain", "b_start", "b_end", "q_from", "q_to")


@_register(f"WITH {X.SEQUENCES} SELECT doc_id, coalesce(seq, '') AS seq FROM seqs")
def fasta_round_trip(spark, d):
    path = shared_path(spark, "fasta")
    N.write_lines(N.fasta_lines(X.sequences(spark, d), "doc_id", "seq"), path)
    return N.read_fasta(spark, path).select(F.col("header").cast("bigint").alias("doc_id"), "seq")


@_register(f"WITH {X.SEQUENCES} SELECT doc_id AS id, substr(seq, CAST(doc_id % 50 + 1 AS BIGINT), CAST(length(seq) // 2 AS BIGINT)) AS seq FROM seqs WHERE length(seq) > 1 AND length(seq) > doc_id % 50")
def genome_fetch(spark, d):
    s = X.sequences(spark, d)
    genome = N.tiles(s.select(F.col("doc_id").cast("string").alias("header"), "seq"), 64)
    regions = s.filter("length(seq) > 1").selectExpr("doc_id AS id", "CAST(doc_id AS STRING) AS chrom", "doc_id % 50 AS start", "doc_id % 50 + length(seq) div 2 AS end")
    return N.fetch(regions, genome, 64)


_SITES = {"kind": "CASE WHEN (tx + g.s) % 3 = 0 THEN 'U12' ELSE 'U2' END", "donor": "substring('gtatgcnn', CAST(1 + 2 * (tx % 4) AS INT), 2)", "acceptor": "substring('agacnntt', CAST(1 + 2 * (g.s % 4) AS INT), 2)"}


@_register(f"""WITH {X.EXONS}, i AS (SELECT tx, chrom, e_end AS s, lead(e_start) OVER (PARTITION BY tx ORDER BY e_start, e_end) AS e FROM exons), g AS (SELECT tx, chrom, s, e FROM i WHERE e > s),
m AS (SELECT DISTINCT tx, chrom, s, e, {', '.join(f'{v} AS {k}' for k, v in _SITES.items())} FROM g)
SELECT tx, s, e, kind, (donor IN ('gt', 'nn') OR (kind = 'U2' AND donor = 'gc')) AND acceptor IN ('ag', 'nn') AS regular FROM m""")
def intron_classes(spark, d):
    rows = I.collect_blocks(X.exons(spark, d)).select("tx", "chrom", F.explode(I.complement_blocks("blocks")).alias("g")).distinct()
    named = rows.selectExpr("chrom", "g.s", "g.e", f"concat('intron', tx, '_', {_SITES['kind']}, '_', {_SITES['donor']}, '-', {_SITES['acceptor']}) AS name", "'0' AS score", "'+' AS strand", "tx")
    path = shared_path(spark, "introns")
    N.write_lines(named.select(F.concat_ws("\t", "chrom", "s", "e", "name", "score", "strand").alias("value")), path)
    # introns of several transcripts at the same place are told apart by their donor, which the id decides
    back = N.read_introns(spark, path).select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), "strand", "kind", "donor", "acceptor", "regular").distinct()
    key = named.selectExpr("tx", "chrom", "s", "e", "strand", "regexp_extract(name, '_([^_]+)_([^_-]+)-', 1) AS kind", "regexp_extract(name, '_([^_]+)_([^_-]+)-', 2) AS donor")
    return key.join(back, ["chrom", "s", "e", "strand", "kind", "donor"]).select("tx", "s", "e", "kind", "regular")


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {X.SPANS},
f AS (SELECT t.tx, b.chain, CAST(sum(least(t_end + 10000, b_end) - greatest(greatest(1, t_start - 10000), b_start)) AS BIGINT) AS n FROM ts t JOIN blocks b ON t.chrom = b.chrom AND greatest(1, t_start - 10000) < b_end AND b_start < t_end + 10000 GROUP BY t.tx, b.chain),
g AS (SELECT t.tx, b.chain, CAST(sum(least(t_end, b_end) - greatest(t_start, b_start)) AS BIGINT) AS n FROM ts t JOIN blocks b ON t.chrom = b.chrom AND t_start < b_end AND b_start < t_end GROUP BY t.tx, b.chain)
SELECT f.tx, f.chain, f.n - coalesce(g.n, 0) AS flank_cover FROM f LEFT JOIN g ON f.tx = g.tx AND f.chain = g.chain""")
def flank_coverage(spark, d):
    return A.flank_coverage(C.transcript_spans(X.exons(spark, d)), X.blocks(spark, d))


@_register(f"""WITH {X.EXONS}, {X.BLOCKS}, {catalogue._COVERAGE}, t AS (SELECT chain, CAST(sum(b_end - b_start) AS BIGINT) AS bases FROM blocks GROUP BY chain), c AS (SELECT chain, CAST(sum(cov) AS BIGINT) AS cds FROM coverage GROUP BY chain)
SELECT chain, coalesce(cds, 0) AS cds, bases, coalesce(cds, 0) * 1000 // bases AS gl_exo FROM t LEFT JOIN c USING (chain)""")
def global_exon_share(spark, d):
    blocks = X.blocks(spark, d)
    return A.global_exon_share(C.block_exon_coverage(X.exons(spark, d), blocks), blocks)


_STATE = "replace(translate(coalesce(seq, ''), 'ACGT', 'ILDM'), 'II', 'IA')"
_RUN = "list_max(list_transform(string_split({}, 'L'), lambda x: length(x)))"


@_register(f"""WITH {X.SEQUENCES}, s AS (SELECT doc_id, {_STATE} AS s, length(coalesce(seq, '')) AS n FROM seqs),
c AS (SELECT *, n // 10 AS cut, length(replace(replace(s, 'M', ''), 'X', '')) AS present, replace(replace(s, 'D', ''), 'A', 'L') AS x FROM s)
SELECT doc_id, CASE WHEN n > 0 THEN {_RUN.format("replace(x, 'M', '')")} * 1000 // n ELSE 0 END AS strict, CASE WHEN n > 0 THEN {_RUN.format("replace(x, 'M', 'I')")} * 1000 // n ELSE 0 END AS relaxed,
CASE WHEN present > 0 THEN (2 * n - length(replace(s, 'I', '')) - length(replace(s, 'A', ''))) * 1000 // present ELSE 1000 END AS total,
NOT contains(substr(s, cut + 1, n - 2 * cut), 'L') AS middle_intact, NOT contains(substr(s, cut + 1, n - 2 * cut), 'M') AS middle_present FROM c""")
def codon_metrics(spark, d):
    return A.codon_metrics(X.sequences(spark, d).selectExpr("doc_id", f"{_STATE} AS s"), "doc_id", "s")


_QUERY = "replace(replace(replace(seq, 'GAT', '---'), 'CC', '--'), 'TAA', 'TAC')"


@_register(f"""WITH {X.SEQUENCES}, p AS (SELECT doc_id, seq, {_QUERY} AS q, unnest(range((length(seq) + 2) // 3)) AS i FROM seqs), c AS (SELECT doc_id, i + 1 AS codon, substr(seq, 3 * i + 1, 3) AS ref_codon, substr(q, 3 * i + 1, 3) AS triplet FROM p),
k AS (SELECT *, CASE WHEN replace(triplet, '-', '') = '' THEN 'DELETED' WHEN contains(triplet, '-') THEN 'FRAMESHIFT' WHEN triplet IN ('TAA', 'TAG', 'TGA') AND ref_codon NOT IN ('TAA', 'TAG', 'TGA') THEN 'NONSENSE'
WHEN triplet NOT IN ('TAA', 'TAG', 'TGA') AND ref_codon IN ('TAA', 'TAG', 'TGA') THEN 'STOP_LOSS' WHEN codon = 1 AND ref_codon = 'ATG' AND triplet <> 'ATG' THEN 'START_LOSS' END AS kind FROM c) SELECT * FROM k WHERE kind IS NOT NULL""")
def mutation_calls(spark, d):
    return A.codon_mutations(X.sequences(spark, d).selectExpr("doc_id", "seq AS ref", f"{_QUERY} AS query"), "doc_id")


_ORDER = ["exon", "l_partkey", "l_suppkey", "l_extendedprice"]


@_register(f"""WITH r AS (SELECT l_orderkey AS tx, l_linenumber AS exon, l_partkey % 7 - 3 AS shift, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE (l_partkey % 7 - 3) % 3 <> 0),
a AS (SELECT *, sum(shift) OVER (PARTITION BY tx ORDER BY {', '.join(_ORDER)} ROWS UNBOUNDED PRECEDING) % 3 = 0 AS back FROM r),
g AS (SELECT *, CAST(sum(CAST(back AS INT)) OVER (PARTITION BY tx ORDER BY {', '.join(_ORDER)} ROWS UNBOUNDED PRECEDING) AS BIGINT) - CAST(back AS INT) AS run FROM a)
SELECT tx, run, min(exon) AS first, max(exon) AS last, count(*) AS n, bool_or(back) AS compensated FROM g GROUP BY tx, run""")
def compensated_frames(spark, d):
    rows = X.table(spark, d, "lineitem").select("*", F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("exon"), (F.col("l_partkey") % 7 - 3).alias("shift"))
    return A.frame_runs(rows, ["tx"], _ORDER, "shift")


_PRESENCE = {
    "tx": "l_orderkey", "exon": "CAST(l_linenumber AS BIGINT)", "n_exons": "CAST(1 + l_orderkey % 7 AS BIGINT)", "length": "CAST(l_quantity AS BIGINT)", "defined": "l_partkey % 100", "nuc": "(l_partkey * 3) % 101", "blosum": "(l_suppkey * 7) % 101",
    "aligned": "l_partkey % 2 = 0", "expected": "l_suppkey % 2 = 0", "in_gap": "l_partkey % 3 = 0", "acceptor_ok": "l_partkey % 5 < 2", "donor_ok": "l_suppkey % 5 < 2", "assembly_gap": "l_partkey % 11 = 0", "out_of_chain": "l_suppkey % 4 = 0",
}


@_register(f"""WITH e AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _PRESENCE.items())} FROM lineitem),
p AS (SELECT *, CASE WHEN defined < 10 THEN 'M' WHEN aligned AND expected AND NOT in_gap THEN 'I' WHEN nuc >= 45 AND blosum >= 20 THEN 'I' WHEN (acceptor_ok OR (n_exons > 1 AND exon = 1)) AND (donor_ok OR (n_exons > 1 AND exon = n_exons)) THEN 'I'
WHEN assembly_gap OR out_of_chain THEN 'M' WHEN (exon = 1 OR exon = n_exons) AND length < 20 THEN 'M' ELSE 'D' END AS presence FROM e) SELECT tx, exon, presence, presence = 'D' AND n_exons > 1 AND length % 3 = 0 AS masked FROM p""")
def exon_presence(spark, d):
    return A.exon_presence(X.table(spark, d, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _PRESENCE.items()]))


@_register("""WITH e AS (SELECT l_orderkey AS tx, CAST(l_quantity AS BIGINT) AS len, l_partkey % 2 = 0 AS missing FROM lineitem),
s AS (SELECT tx, sum(len) AS n, max(len * 2 + CAST(missing AS INT)) AS top, sum(CASE WHEN missing THEN len ELSE 0 END) AS gone FROM e GROUP BY tx)
SELECT tx, CASE WHEN CASE WHEN (top // 2) * 10 > n * 4 THEN top % 2 = 1 ELSE gone * 2 >= n END THEN 'M' ELSE 'L' END AS status FROM s""")
def unaligned_projection_status(spark, d):
    return A.unaligned_status(X.table(spark, d, "lineitem").selectExpr("l_orderkey AS tx", "CAST(l_quantity AS BIGINT) AS len", "l_partkey % 2 = 0 AS missing"))


@_register(f"WITH {catalogue._CLASSES}, m AS (SELECT c.tx, c.chain, c.class, c.pred, c.score % 100 AS cover, max(pred) OVER (PARTITION BY tx) AS best FROM classes c) SELECT tx, chain FROM m WHERE class = 'ORTH' AND pred < best AND cover < 60")
def overextended_orthologs(spark, d):
    return A.overextended(P.classify(X.features(spark, d)).withColumn("cover", F.col("score") % 100), "cover")


@_register("SELECT l_orderkey AS tx, l_partkey % 4 AS exon FROM lineitem GROUP BY 1, 2 HAVING bool_and(l_suppkey % 3 = 0)")
def universally_missing(spark, d):
    return A.universally_missing(X.table(spark, d, "lineitem").selectExpr("l_orderkey AS tx", "l_partkey % 4 AS exon", "l_suppkey % 3 = 0 AS missing"))


@_register("WITH c AS (SELECT l_orderkey AS tx, l_returnflag AS r, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1, 2) SELECT tx, string_agg(r || ':' || CAST(n AS VARCHAR), ';' ORDER BY r) AS reasons FROM c GROUP BY tx")
def rejection_counts(spark, d):
    return A.reason_counts(X.table(spark, d, "lineitem").selectExpr("l_orderkey AS tx", "l_returnflag AS reason"), "tx", "reason")


@_register(f"""WITH {X.EDGES}, a AS (SELECT r, q FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY weight DESC, q) AS i FROM edges) z WHERE i = 1), b AS (SELECT r, q FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY weight DESC, r) AS i FROM edges) z WHERE i = 1),
s AS (SELECT a.r, a.q FROM a JOIN b ON a.r = b.r AND a.q = b.q), l AS (SELECT r, q FROM edges WHERE r NOT IN (SELECT r FROM s) AND q NOT IN (SELECT q FROM s)), k AS (SELECT *, count(*) OVER (PARTITION BY r) > 1 AS mq, count(*) OVER (PARTITION BY q) > 1 AS mr FROM l)
SELECT r, q, CASE WHEN mq AND mr THEN 'many2many' WHEN mq THEN 'one2many' WHEN mr THEN 'many2one' ELSE 'one2one' END AS class FROM k""")
def residual_orthology(spark, d):
    edges = X.edges(spark, d)
    return A.residual_graph(edges, A.best_pairs(edges))


@_register("SELECT l_orderkey, l_linenumber, 'tx#' || CAST(l_orderkey AS VARCHAR) AS tx, CAST(1 + l_partkey % 2 AS INTEGER) AS n_chains, l_suppkey % 2 = 0 AS retro FROM lineitem")
def projection_ids(spark, d):
    name = "concat('tx#', l_orderkey, '#', l_linenumber, CASE WHEN l_partkey % 2 = 1 THEN ',7' ELSE '' END, CASE WHEN l_suppkey % 2 = 0 THEN '#retro' ELSE '' END)"
    tx, chains, retro = A.split_projection(F.col("name"))
    rows = X.table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{name} AS name")
    return rows.select("l_orderkey", "l_linenumber", tx.alias("tx"), F.size(chains).alias("n_chains"), retro.alias("retro"))


_LOCI = {"proj": "c_custkey", "tx": "c_custkey % 400", "chrom": "c_nationkey % 5", "strand": "c_custkey % 2", "e_start": "(c_custkey * 7919) % 1000000", "e_end": "(c_custkey * 7919) % 1000000 + 300"}
_REFS = {"tx": "c_custkey % 400", "chrom": "c_custkey % 3", "e_start": "(c_custkey % 400) * 997 % 90000", "e_end": "(c_custkey % 400) * 997 % 90000 + 400"}


@_register(f"""WITH RECURSIVE p AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _LOCI.items())} FROM customer), t AS (SELECT DISTINCT {', '.join(f'{e} AS {c}' for c, e in _REFS.items())} FROM customer),
apart AS (SELECT DISTINCT a.tx AS l, b.tx AS h FROM t a JOIN t b ON a.chrom = b.chrom AND a.tx < b.tx AND a.e_start < b.e_end AND b.e_start < a.e_end),
links AS (SELECT a.proj AS a, b.proj AS b FROM p a JOIN p b ON a.chrom = b.chrom AND a.strand = b.strand AND a.proj <> b.proj AND a.e_start < b.e_end AND b.e_start < a.e_end WHERE (least(a.tx, b.tx), greatest(a.tx, b.tx)) NOT IN (SELECT (l, h) FROM apart)),
w(a, b) AS (SELECT proj, proj FROM p UNION SELECT w.a, links.b FROM w JOIN links ON w.b = links.a), r AS (SELECT a AS proj, min(b) AS root FROM w GROUP BY a),
g AS (SELECT chrom, root, min(e_start) AS g_start, max(e_end) AS g_end, count(*) AS n FROM p JOIN r USING (proj) GROUP BY chrom, root)
SELECT chrom, CAST(row_number() OVER (PARTITION BY chrom ORDER BY g_start, g_end, root) AS INTEGER) AS locus, g_start, g_end, n FROM g""")
def query_gene_loci(spark, d):
    customers = X.table(spark, d, "customer")
    refs = customers.selectExpr(*[f"{e} AS {c}" for c, e in _REFS.items()]).distinct()
    return L.query_gene_loci(customers.selectExpr(*[f"{e} AS {c}" for c, e in _LOCI.items()]), L.overlapping_pairs(refs, "tx", ["chrom"]))


@_register(f"""WITH {X.FEATURE_CTE}, {X.ISOFORMS}, f AS (SELECT gene, tx, chain, max(exon_cover) AS exon_cover, max(ex_fract) AS ex_fract, max(pred) AS pred FROM features JOIN isoforms USING (tx) WHERE gene IN (SELECT c_custkey % 500 FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey < 9) = 1) GROUP BY gene, tx, chain),
p AS (SELECT gene, tx FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY ex_fract DESC, tx, chain) AS i FROM f) z WHERE i = 1),
b AS (SELECT f.*, row_number() OVER (PARTITION BY gene ORDER BY pred DESC, chain) AS i, count(*) OVER (PARTITION BY gene) AS chains FROM f JOIN p USING (gene, tx))
SELECT gene, tx, chain, CAST(i = 1 AS INTEGER) AS y FROM b WHERE i > 1 OR (exon_cover > 10 AND chains <= 10)""")
def training_rows(spark, d):
    features = X.features(spark, d).groupBy("tx", "chain").agg(*[F.max(c).alias(c) for c in ("exon_cover", "ex_fract", "pred")])
    # a reference gene has a query gene for each of two groups of nations, so some have two
    pairs = X.table(spark, d, "customer").selectExpr("c_custkey % 500 AS r", "concat(c_custkey % 500, c_nationkey < 9) AS q").distinct()
    one2one = A.residual_graph(pairs, pairs.limit(0)).filter("class = 'one2one'").select(F.col("r").alias("gene"))
    return L.training_rows(features, X.isoforms(spark, d), one2one)
