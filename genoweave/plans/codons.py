"""Queries of the codon walk, with their SQL."""

from __future__ import annotations

from genoweave.operators import codons
from genoweave.plans import fixtures as X

QUERIES, ORACLES = {}, {}


def _register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# every whole sequence against itself: some words are gaps in either row, and two long stretches are lost in one of them
_REF = "replace(replace(seq, 'GCA', '---'), 'TA', '--')"
_QUERY = "replace(replace(replace(seq, 'TTT', '---'), 'CAT', '-AT'), 'GGA', 'TGA')"
_PAIRS = """SELECT doc_id, CASE WHEN length(seq) > 300 THEN concat(substring(r, 1, 60), repeat('-', CAST(48 + doc_id % 13 AS INT)), substring(r, CAST(109 + doc_id % 13 AS INT))) ELSE r END AS ref,
  CASE WHEN length(seq) > 300 THEN concat(substring(q, 1, 180), repeat('-', CAST(45 + doc_id % 17 AS INT)), substring(q, CAST(226 + doc_id % 17 AS INT))) ELSE q END AS query
  FROM (SELECT doc_id, seq, {r} AS r, {q} AS q FROM seqs) z""".format(r=_REF, q=_QUERY)
_STOPS = "('TAA', 'TAG', 'TGA')"


def _masked(c: str) -> str:
    return f"CASE WHEN {c} = '---' THEN {c} WHEN {c} IN {_STOPS} OR contains({c}, '-') OR length({c}) < 3 THEN 'XXX' ELSE {c} END"


_CHUNKS = f"""{X.SEQUENCES}, pairs AS ({_PAIRS}),
cut AS (SELECT doc_id, regexp_extract_all(array_to_string(list_transform(list_zip(string_split(ref, ''), string_split(query, '')), lambda x: x[1] || x[2]), ''),
  '(?:-.){{3}}|(?:-.){{0,2}}[^-].(?:-.)*[^-].(?:-.)*[^-].|.+') AS cs FROM pairs WHERE ref <> ''),
pieces AS (SELECT doc_id, k, regexp_replace(c, '(.).', '\\1', 'g') AS r, regexp_replace(c, '.(.)', '\\1', 'g') AS q FROM (SELECT doc_id, unnest(cs) AS c, unnest(range(len(cs))) AS k FROM cut) z),
chunks AS (SELECT doc_id, k, r, q, length(r) % 3 AS head, 1 + count(*) FILTER (r <> '---') OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS codon
  FROM pieces WHERE r = '---' OR length(replace(r, '-', '')) = 3)"""
_WALK = f"""{_CHUNKS},
parts AS (SELECT doc_id, k, codon, -1 AS j, substring(r, 1, head) AS r, substring(q, 1, head) AS q, '---' AS rm, 'XXX' AS qm FROM chunks WHERE head > 0
  UNION ALL SELECT doc_id, k, codon, j, substring(r, CAST(head + 1 + 3 * j AS INT), 3), substring(q, CAST(head + 1 + 3 * j AS INT), 3), NULL, NULL FROM (SELECT *, unnest(range(length(r) // 3)) AS j FROM chunks) z),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS triplet, count(*) OVER (PARTITION BY doc_id) AS n FROM parts),
walk AS (SELECT doc_id, triplet, codon, r, q, CASE WHEN triplet = n AND r IN {_STOPS} THEN r ELSE COALESCE(rm, {_masked('r')}) END AS r_masked,
  CASE WHEN triplet = n AND r IN {_STOPS} THEN q ELSE COALESCE(qm, {_masked('q')}) END AS q_masked, triplet = n AS is_last FROM numbered)"""
# runs of gaps as islands: triplets less their rank among the gaps stay the same inside a run
_EVENTS = f"""{_WALK},
marks AS (SELECT *, length(q) - length(replace(q, '-', '')) AS qg, length(r) - length(replace(r, '-', '')) AS rg, r <> r_masked OR q <> q_masked AS changed FROM walk),
ins AS (SELECT doc_id, min(triplet) AS a, max(triplet) + 1 AS b FROM (SELECT doc_id, triplet, triplet - row_number() OVER (PARTITION BY doc_id ORDER BY triplet) AS g FROM walk WHERE r = '---') z GROUP BY doc_id, g),
del AS (SELECT doc_id, min(triplet) AS a, max(triplet) + 1 AS b FROM (SELECT doc_id, triplet, triplet - row_number() OVER (PARTITION BY doc_id ORDER BY triplet) AS g FROM walk WHERE q = '---') z GROUP BY doc_id, g),
events AS (SELECT doc_id, 'START_MISSING' AS kind, triplet AS first, triplet AS last, codon, r_masked || '->' || q_masked AS detail, true AS masked, 'Missing start masked' AS reason FROM marks WHERE triplet = 1 AND r_masked = 'ATG' AND q_masked <> 'ATG'
  UNION ALL SELECT doc_id, CASE WHEN rg > qg THEN 'FS_INS' ELSE 'FS_DEL' END, triplet, triplet, codon, CAST(rg - qg AS VARCHAR), false, '-' FROM marks WHERE changed AND (rg - qg) % 3 <> 0
  UNION ALL SELECT doc_id, CASE WHEN r = 'NNN' THEN 'SELENOCYSTEINE' ELSE 'STOP' END, triplet, triplet, codon, r || '->' || q, false, '-' FROM marks WHERE changed AND q IN {_STOPS} AND r NOT IN {_STOPS}
  UNION ALL SELECT doc_id, 'BIG_INS', a, b, codon, '+' || CAST(3 * (b - a) AS VARCHAR), true, '-' FROM ins JOIN walk USING (doc_id) WHERE triplet = b AND 3 * (b - a) > 50
  UNION ALL SELECT doc_id, 'BIG_DEL', a, b, codon, '-' || CAST(3 * (b - a) AS VARCHAR), true, '-' FROM del JOIN walk USING (doc_id) WHERE triplet = b AND 3 * (b - a) > 50
  UNION ALL SELECT doc_id, 'STOP_MISSING', triplet, triplet, codon, r || '->' || q, true, CASE WHEN r IN {_STOPS} THEN 'Missing stop masked' ELSE 'Non-canonical stop in reference' END FROM marks WHERE is_last AND q NOT IN {_STOPS})"""


def _pairs(spark, d):
    return spark.sql(_PAIRS.replace("FROM seqs", "FROM {seqs}"), seqs=X.sequences(spark, d))


@_register(f"WITH {_WALK} SELECT doc_id, triplet, codon, r, q, r_masked, q_masked FROM walk")
def codon_triplets(spark, d):
    return codons.codon_walk(_pairs(spark, d), "doc_id").select("doc_id", "triplet", "codon", "r", "q", "r_masked", "q_masked")


@_register(f"WITH {_EVENTS} SELECT * FROM events")
def codon_events(spark, d):
    return codons.codon_events(codons.codon_walk(_pairs(spark, d), "doc_id"), "doc_id")


@_register()
def shifted_frames(spark, d):
    return codons.shifted_frames(_pairs(spark, d), "doc_id")


_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"  # fixed values: the genetic code, codons in TCAG order
_RESIDUES = "ACDEFGHIKLMNPQRSTVWXY*"
_SCORE = "CASE WHEN a = b THEN 4 + ascii(a) % 5 ELSE (ascii(a) * ascii(b)) % 7 - 4 END"


@_register(f"""WITH {_CHUNKS},
code AS (SELECT substring('TCAG', CAST(i // 16 + 1 AS INT), 1) || substring('TCAG', CAST(i // 4 % 4 + 1 AS INT), 1) || substring('TCAG', CAST(i % 4 + 1 AS INT), 1) AS codon, substring('{_AMINO}', CAST(i + 1 AS INT), 1) AS aa FROM range(64) t(i) UNION ALL SELECT '---', '-'),
rows_ AS (SELECT *, unnest(range(length(r) // 3)) AS j FROM chunks),
two AS (SELECT rows_.doc_id, CASE WHEN j < length(r) // 3 - 1 OR r = '---' THEN '-' ELSE COALESCE(o.aa, 'X') END AS a, CASE WHEN head > 0 THEN 'X' ELSE COALESCE(c.aa, 'X') END AS b
  FROM rows_ LEFT JOIN code o ON o.codon = replace(r, '-', '') LEFT JOIN code c ON c.codon = substring(q, CAST(3 * j + 1 AS INT), 3)),
scores AS (SELECT doc_id, sum(CASE WHEN a = '-' THEN 0 ELSE 4 + ascii(a) % 5 END) AS self_score, sum(CASE WHEN a = '-' AND b = '-' THEN 0 WHEN a = '-' OR b = '-' THEN -1 ELSE {_SCORE} END) AS pair_score FROM two GROUP BY doc_id),
same AS (SELECT doc_id, count(*) FILTER (a <> '-' AND a = b) AS n_same, count(*) FILTER (a <> '-') AS ref_len FROM (SELECT doc_id, unnest(string_split(ref, '')) AS a, unnest(string_split(query, '')) AS b FROM pairs WHERE ref <> '') z GROUP BY doc_id),
every AS (SELECT doc_id, COALESCE(n_same, 0) AS n_same, COALESCE(ref_len, 0) AS ref_len, COALESCE(self_score, 0) AS self_score, COALESCE(pair_score, 0) AS pair_score FROM pairs LEFT JOIN same USING (doc_id) LEFT JOIN scores USING (doc_id))
SELECT doc_id, CAST(n_same AS BIGINT) AS n_same, CAST(ref_len AS BIGINT) AS ref_len, CAST(self_score AS BIGINT) AS self_score, CAST(pair_score AS BIGINT) AS pair_score,
  CASE WHEN ref_len > 0 THEN n_same * 100.0::DOUBLE / ref_len ELSE 0.0::DOUBLE END AS nuc, CASE WHEN self_score > 0 THEN greatest(pair_score, 0) * 100.0::DOUBLE / self_score ELSE 0.0::DOUBLE END AS residue FROM every""")
def pair_identity(spark, d):
    score = lambda a, b: 4 + ord(a) % 5 if a == b else ord(a) * ord(b) % 7 - 4
    matrix = spark.createDataFrame([(a, b, score(a, b)) for a in _RESIDUES for b in _RESIDUES], "a string, b string, score long")
    return codons.pair_identity(_pairs(spark, d), "doc_id", matrix)
