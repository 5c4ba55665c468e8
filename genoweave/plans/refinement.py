"""Registered queries of the refinement of projections, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.operators import intervals as I
from genoweave.operators import refinement as R
from genoweave.plans import fixtures as X

QUERIES: dict = {}
ORACLES: dict = {}


def _register(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _columns(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in exprs.items())


def _view(spark, d, table: str, exprs: dict[str, str]):
    return X.table(spark, d, table).selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])


_SITES = {
    "tx": "tx", "exon": "exon", "n_exons": "max(exon) OVER (PARTITION BY tx)", "aligned": "(tx + exon) % 9 <> 0",
    "acceptor": "CASE (tx * 3 + exon) % 7 WHEN 0 THEN 'AG' WHEN 1 THEN 'tg' WHEN 2 THEN 'nG' WHEN 3 THEN 'g' WHEN 4 THEN 'aa' ELSE 'ag' END",
    "donor": "CASE (tx + exon * 2) % 6 WHEN 0 THEN 'GT' WHEN 1 THEN 'gc' WHEN 2 THEN 'at' WHEN 3 THEN 'G' WHEN 4 THEN 'ct' ELSE 'an' END",
    "ref_acceptor": "CASE WHEN tx % 4 = 0 THEN 'ac' ELSE 'ag' END", "ref_donor": "CASE WHEN tx % 5 = 0 THEN 'AT' ELSE 'GT' END",
    "acceptor_u12": "tx % 11 = 0", "donor_u12": "tx % 13 = 0", "intron_deleted": "(tx + exon) % 3 = 0",
}


@_register(f"""WITH {X.EXONS}, one AS (SELECT DISTINCT tx, exon FROM exons), s AS (SELECT {_columns(_SITES)} FROM one),
h AS (SELECT *, lower(acceptor) AS a, lower(donor) AS d, aligned AND exon > 1 AND lower(acceptor) <> 'ag' AS ha, aligned AND exon < n_exons AND lower(donor) NOT IN ('gt', 'gc') AS hd FROM s),
g AS (SELECT *, coalesce(ha AND NOT contains(a, 'n') AND length(a) = 2 AND lag(hd AND intron_deleted) OVER (PARTITION BY tx ORDER BY exon), false) AS gone FROM h),
n AS (SELECT *, coalesce(lead(gone) OVER (PARTITION BY tx ORDER BY exon), false) AS gone_after FROM g)
SELECT tx, exon, 'SSMA' AS class, ref_acceptor AS ref_site, CASE WHEN gone THEN '--' ELSE lpad(a, 2, '?') END AS site,
  CASE WHEN gone THEN 'Intron deletion' WHEN contains(a, 'n') THEN 'Ambiguous symbol' WHEN length(a) < 2 THEN 'Insufficient data' WHEN acceptor_u12 THEN 'U12 intron' WHEN lower(ref_acceptor) <> 'ag' THEN 'Non-canonical U2 intron' END AS reason FROM n WHERE ha
UNION ALL SELECT tx, exon, 'SSMD', ref_donor, CASE WHEN gone_after THEN '--' ELSE rpad(d, 2, '?') END,
  CASE WHEN gone_after THEN 'Intron deletion' WHEN contains(d, 'n') THEN 'Ambiguous symbol' WHEN length(d) < 2 THEN 'Insufficient data' WHEN donor_u12 THEN 'U12 intron' WHEN lower(ref_donor) NOT IN ('gt', 'gc') THEN 'Non-canonical U2 intron' END FROM n WHERE hd""")
def splice_site_mutations(spark, d):
    sites = X.exons(spark, d).select("tx", "exon").distinct().selectExpr(*[f"{e} AS {c}" for c, e in _SITES.items()])
    return R.splice_site_mutations(sites)


_MUTATIONS = {
    "proj": "l_orderkey", "mut": "l_linenumber", "exon": "1 + l_linenumber % 4", "codon": "1 + (l_suppkey * 7 + l_partkey) % 100", "n_codons": "100", "n_exons": "CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 4 END",
    "class": "CASE (l_partkey + l_linenumber) % 9 WHEN 0 THEN 'Deleted exon' WHEN 1 THEN 'Missing exon' WHEN 2 THEN 'COMPENSATION' WHEN 3 THEN 'BIG_DEL' WHEN 4 THEN 'STOP' WHEN 5 THEN 'SSMA' ELSE 'FS_DEL' END",
    "reason": "CASE WHEN l_partkey % 8 = 0 THEN 'Compensated' WHEN l_partkey % 8 = 1 THEN 'U12 intron' WHEN l_partkey % 8 = 2 THEN 'Alternative frame found' END",
}
_FATES = {"proj": "l_orderkey", "exon": "1 + l_linenumber % 4", "presence": "CASE (l_orderkey + l_linenumber % 4) % 6 WHEN 0 THEN 'D' WHEN 1 THEN 'M' ELSE 'I' END"}


@_register(f"""WITH m AS (SELECT {_columns(_MUTATIONS)} FROM lineitem), f AS (SELECT DISTINCT {_columns(_FATES)} FROM lineitem), s AS (SELECT o_orderkey AS proj, max(1 + o_custkey % 30) AS atg FROM orders WHERE 1 + o_custkey % 30 <= 10 GROUP BY 1),
p AS (SELECT m.*, presence, atg, reason IS NOT NULL OR class IN ('COMPENSATION', 'Missing exon') OR (class = 'Deleted exon' AND n_exons = 1) AS settled FROM m LEFT JOIN f USING (proj, exon) LEFT JOIN s USING (proj)),
x AS (SELECT *, CASE WHEN NOT settled AND class <> 'Deleted exon' THEN CASE presence WHEN 'D' THEN 'Exon is deleted' WHEN 'M' THEN 'Exon is missing' END END AS by_exon FROM p),
y AS (SELECT *, CASE WHEN settled OR by_exon IS NOT NULL THEN NULL WHEN codon <= 10 AND class <> 'Deleted exon' THEN 'N-terminal' WHEN codon >= 90 THEN 'C-terminal' WHEN atg > codon THEN 'Alternative start found' END AS place FROM x),
z AS (SELECT *, coalesce(reason, by_exon, place) AS why, bool_or(class = 'Deleted exon' AND place IS NOT NULL) OVER (PARTITION BY proj, exon) AS spared FROM y),
w AS (SELECT *, bool_or(why IS NULL AND class IN ('STOP', 'SSMA', 'FS_DEL', 'Deleted exon') AND NOT (class = 'Deleted exon' AND spared)) OVER (PARTITION BY proj) AS hit FROM z)
SELECT proj, mut, class, CASE WHEN hit AND (place IS NOT NULL OR reason IN ('Compensated', 'Alternative frame found')) THEN NULL ELSE why END AS reason FROM w""")
def masked_mutations(spark, d):
    starts = X.table(spark, d, "orders").selectExpr("o_orderkey AS proj", "1 + o_custkey % 30 AS codon")
    return R.masked_mutations(_view(spark, d, "lineitem", _MUTATIONS), _view(spark, d, "lineitem", _FATES), starts, mask_start=True)


_ENDS = {"doc_id": "doc_id", "seq": "seq", "start": "CAST(length(seq) * 3 {0} 5 AS INT)", "stop": "CAST(3 + length(seq) {0} 4 AS INT)", "ref_start": "CASE WHEN doc_id % 5 = 0 THEN 'CTG' ELSE 'ATG' END", "ref_stop": "CASE WHEN doc_id % 7 = 0 THEN 'TTA' ELSE 'TAG' END"}


@_register(f"""WITH {X.SEQUENCES}, e AS (SELECT {_columns(_ENDS).format('//')} FROM seqs)
SELECT doc_id, CASE WHEN ref_start = 'ATG' AND substr(seq, start + 1, 3) <> 'ATG' THEN coalesce((SELECT max(i) FROM range(start % 3, start, 3) r(i) WHERE i > 0 AND substr(seq, CAST(i + 1 AS INT), 3) = 'ATG'), start) ELSE start END AS q_start,
  CASE WHEN ref_stop = 'TAG' AND substr(seq, stop - 2, 3) NOT IN ('TAA', 'TAG', 'TGA') THEN coalesce((SELECT min(i) + 3 FROM range(stop, length(seq), 3) r(i) WHERE substr(seq, CAST(i + 1 AS INT), 3) IN ('TAA', 'TAG', 'TGA')), stop) ELSE stop END AS q_stop FROM e""")
def rescued_ends(spark, d):
    rows = X.sequences(spark, d).selectExpr(*[f"{e.format('div')} AS {c}" for c, e in _ENDS.items()])
    first, last = R.alternative_start(F.col("seq"), F.col("start"), F.col("ref_start")), R.alternative_stop(F.col("seq"), F.col("stop"), F.col("ref_stop"))
    return rows.select("doc_id", first.cast("bigint").alias("q_start"), last.cast("bigint").alias("q_stop"))


_FOUND = {
    "proj": "tx", "tx": "tx", "first": "CAST(1 AS BIGINT)", "last": "n", "low": "least(n, 1 + tx % 3)", "high": "greatest(least(n, 1 + tx % 3), n - tx % 2)", "q_start": "tx * 31 % 90000", "q_end": "tx * 31 % 90000 + 5000",
    "forward": "true", "codirected": "tx % 3 > 0", "contig": "CAST(94000 AS BIGINT)", "retro": "tx % 10 = 0",
}


@_register(f"""WITH {X.EXONS}, n AS (SELECT tx, max(exon) AS n FROM exons GROUP BY tx), f AS (SELECT {_columns(_FOUND)} FROM n), e AS (SELECT tx, exon, max(e_start) AS s, max(e_end) AS e FROM exons GROUP BY tx, exon),
d AS (SELECT f.*, CASE WHEN retro THEN 0 ELSE CAST(floor((lo.s - fi.s) * 1.2::DOUBLE) AS BIGINT) END AS up, CASE WHEN retro THEN 0 ELSE CAST(floor((la.e - hi.e) * 1.2::DOUBLE) AS BIGINT) END AS down
  FROM f LEFT JOIN e fi ON fi.tx = f.tx AND fi.exon = f.first LEFT JOIN e lo ON lo.tx = f.tx AND lo.exon = f.low LEFT JOIN e hi ON hi.tx = f.tx AND hi.exon = f.high LEFT JOIN e la ON la.tx = f.tx AND la.exon = f.last)
SELECT proj, greatest(0, q_start - CASE WHEN codirected THEN up ELSE down END) AS s_start, greatest(0, least(q_end + CASE WHEN codirected THEN down ELSE up END, contig)) AS s_end FROM d""")
def search_spaces(spark, d):
    exons = X.exons(spark, d)
    found = exons.groupBy("tx").agg(F.max("exon").alias("n")).selectExpr(*[f"{e} AS {c}" for c, e in _FOUND.items()])
    return R.search_spaces(found, exons)


_CLASSES = {"tx": "l_orderkey", "chain": "l_linenumber", "class": "CASE l_partkey % 5 WHEN 0 THEN 'ORTH' WHEN 1 THEN 'SPAN' WHEN 2 THEN 'P_PGENE' ELSE 'PARA' END"}


@_register(f"""WITH c AS (SELECT {_columns(_CLASSES)} FROM lineitem), o AS (SELECT tx, count(*) FILTER (class = 'ORTH') AS n, min(CASE class WHEN 'ORTH' THEN 1 WHEN 'SPAN' THEN 2 WHEN 'PARA' THEN 3 END) AS best FROM c GROUP BY tx)
SELECT tx, NULL AS chain, 'MULTIPLE_ORTHOLOGS' AS reason FROM o WHERE n > 1
UNION ALL SELECT tx, chain, 'LIMIT_EXCEEDED' FROM (SELECT tx, chain, row_number() OVER (PARTITION BY tx ORDER BY chain) AS r FROM c JOIN o USING (tx) WHERE n <= 1 AND best = CASE class WHEN 'ORTH' THEN 1 WHEN 'SPAN' THEN 2 WHEN 'PARA' THEN 3 END) z WHERE r > 3""")
def admission_rejects(spark, d):
    return R.admission_rejects(_view(spark, d, "lineitem", _CLASSES), one2one_only=True, most=3)


@_register(f"""WITH {X.EXONS}, s AS (SELECT tx, chrom, min(e_start) + tx % 4 AS a, CASE WHEN tx % 12 = 0 THEN min(e_start) + tx % 4 ELSE max(e_end) - tx % 5 END AS b FROM exons GROUP BY tx, chrom),
n AS (SELECT s.tx, chrom, a, greatest(a, b) AS b, CASE WHEN s.tx % 10 = 0 THEN 'T ' || CAST(s.tx AS VARCHAR) ELSE 'T.' || CAST(s.tx AS VARCHAR) END AS name FROM s),
l AS (SELECT n.tx, sum(greatest(0, least(e_end, b) - greatest(e_start, a))) AS coding FROM n JOIN exons USING (tx) GROUP BY n.tx)
SELECT name, CASE WHEN contains(name, ' ') THEN 'NAME' WHEN chrom = 'chr4' THEN 'CONTIG' WHEN a = b THEN 'NON_CODING' WHEN coding % 3 <> 0 THEN 'FRAME' END AS reason FROM n JOIN l USING (tx)""")
def annotation_reasons(spark, d):
    rows = I.collect_blocks(X.exons(spark, d)).withColumn("cds_start", F.expr("t_start + tx % 4"))
    rows = rows.withColumn("cds_end", F.expr("greatest(cds_start, CASE WHEN tx % 12 = 0 THEN cds_start ELSE t_end - tx % 5 END)"))
    return R.annotation_reasons(rows.withColumn("name", F.expr("concat(CASE WHEN tx % 10 = 0 THEN 'T ' ELSE 'T.' END, tx)")), exclude=["chr4"])


@_register("""WITH n AS (SELECT concat_ws('.', 'ENST' || CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 2 = 0 THEN 'v1' END, CAST(o_custkey AS VARCHAR)) AS name FROM orders)
SELECT name, array_to_string(string_split(name, '.')[:-2], '.') AS tx, string_split(name, '.')[-1] AS chain FROM n""")
def legacy_projection_ids(spark, d):
    names = X.table(spark, d, "orders").selectExpr("concat_ws('.', concat('ENST', o_orderkey), CASE WHEN o_orderkey % 2 = 0 THEN 'v1' END, CAST(o_custkey AS STRING)) AS name")
    tx, chain = R.split_legacy_projection(F.col("name"))
    return names.select("name", tx.alias("tx"), chain.alias("chain"))
