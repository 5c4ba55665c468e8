"""Queries over alignments, projection graphs and gene trees, with their SQL where it can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.functions import sequence as S
from genoweave.operators import blocks, grouping, splice_hmm, trees
from genoweave.plans import fixtures as X
from genoweave.session import partitions

QUERIES, ORACLES = {}, {}


def _register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@_register()
def codon_hmm(spark, d):
    # every whole sequence in loci of 240 bases: one exon lacks a codon, another gained a base, with an intron between
    loci = X.sequences(spark, d).select("doc_id", F.posexplode(S.chunks(F.col("seq"), 240)).alias("i", "locus"))
    exons = """array(named_struct('seq', concat(substring(locus, 21, 20), substring(locus, 44, 40)), 'phase', 0, 'lo', 20, 'hi', 83),
      named_struct('seq', concat(substring(locus, 141, 31), 'A', substring(locus, 172, 29)), 'phase', 1, 'lo', 140, 'hi', 200))"""
    rows = loci.select(F.concat_ws(":", "doc_id", "i").alias("locus_id"), "locus", F.expr(exons).alias("exons"))
    # aligning costs far more than moving a locus, and a file of texts may be a single task
    return splice_hmm.align_exons(rows.repartition(4 * partitions(spark), "locus_id"), "locus_id", band=16)


# every vertex x is taken out in turn: what a first neighbour of x still reaches, against all of x's component
CUT = f"""{X.EDGES}, {X.COMPONENTS},
near AS (SELECT a AS x, min(b) AS first FROM u GROUP BY a),
walk(x, v) AS (SELECT x, first FROM near UNION SELECT walk.x, u.b FROM walk JOIN u ON walk.v = u.a WHERE u.b <> walk.x),
size AS (SELECT comp, count(*) AS n FROM comp GROUP BY comp),
met AS (SELECT x, count(*) AS n FROM walk GROUP BY x),
cut AS (SELECT met.x AS vertex FROM met JOIN comp ON met.x = comp.node JOIN size ON comp.comp = size.comp WHERE met.n < size.n - 1)"""


@_register(f"WITH RECURSIVE {CUT} SELECT vertex FROM cut")
def articulation_points(spark, d):
    return blocks.articulation_points(X.edges(spark, d), "r", "q").select("vertex")


@_register(f"""WITH RECURSIVE {CUT},
rest AS (SELECT a, b FROM u WHERE a NOT IN (SELECT vertex FROM cut) AND b NOT IN (SELECT vertex FROM cut)),
way(a, b) AS (SELECT node, node FROM comp WHERE node NOT IN (SELECT vertex FROM cut) UNION SELECT way.a, rest.b FROM way JOIN rest ON way.b = rest.a),
again AS (SELECT a AS node, min(b) AS root FROM way GROUP BY a)
SELECT node AS vertex, again.root IS NULL AS chimeric, again.root AS root FROM comp LEFT JOIN again USING (node)""")
def chimera_split(spark, d):
    return blocks.split_chimeras(X.edges(spark, d), "r", "q")


# a tree for every order: lines join in pairs, pairs one after the other; parts name the species, sizes the support
def _gene_trees(spark, d):
    leaf = "concat(CASE WHEN l_partkey % 2 = 0 THEN '#R#' ELSE '' END, 'g', l_partkey % 40, '#', l_linenumber)"
    lines = X.table(spark, d, "lineitem").selectExpr("l_orderkey AS tree", f"struct(l_linenumber AS i, {leaf} AS leaf, CAST(50 + l_quantity AS INT) AS support) AS x")
    grouped = lines.groupBy("tree").agg(F.array_sort(F.collect_list("x")).alias("x"))
    pairs = """transform(sequence(0, (size(x) - 1) div 2), i -> CASE WHEN 2 * i + 1 < size(x)
      THEN concat('(', x[2 * i].leaf, ':1,', x[2 * i + 1].leaf, ':1)', x[2 * i].support) ELSE x[2 * i].leaf END)"""
    joined = "aggregate(slice(p, 2, greatest(size(p) - 1, 0)), p[0], (a, b) -> concat('(', a, ':1,', b, ':1)', x[0].support))"
    return grouped.selectExpr("tree", "x", f"{pairs} AS p").selectExpr("tree", f"concat({joined}, ';') AS newick")


_LEAVES = """leaves AS (SELECT l_orderkey AS tree, l_linenumber AS i, l_partkey % 2 = 0 AS ref, CAST(50 + l_quantity AS INTEGER) AS support,
  CASE WHEN l_partkey % 2 = 0 THEN '#R#' ELSE '' END || 'g' || CAST(l_partkey % 40 AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR) AS leaf FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY i, leaf, support) - 1 AS k, first_value(support) OVER (PARTITION BY tree ORDER BY i, leaf, support) AS top FROM leaves),
cherries AS (SELECT tree, k // 2 AS pair, count(*) AS n, min(top) AS top, arg_min(support, k) AS support, arg_min(leaf, k) AS a, arg_max(leaf, k) AS b,
  CASE WHEN count(*) = 1 THEN CASE WHEN bool_or(ref) THEN 'R' ELSE 'Q' END WHEN bool_and(ref) THEN 'Dr' WHEN bool_or(ref) THEN 'S' ELSE 'Dq' END AS label FROM ranked GROUP BY tree, k // 2),
joined(tree, pair, label) AS (SELECT tree, pair, label FROM cherries WHERE pair = 0
  UNION ALL SELECT c.tree, c.pair, CASE WHEN j.label IN ('D', 'P') OR c.label IN ('D', 'P') THEN 'D' WHEN j.label = 'S' AND c.label = 'S' THEN 'S' WHEN j.label = 'S' OR c.label = 'S' THEN
    'P' WHEN j.label || c.label IN ('RQ', 'QR') THEN 'S' WHEN j.label IN ('R', 'Dr') AND c.label IN ('R', 'Dr') THEN 'Dr' WHEN j.label IN ('Q', 'Dq') AND c.label IN ('Q', 'Dq') THEN 'Dq' ELSE 'D' END
  FROM joined j JOIN cherries c ON j.tree = c.tree AND c.pair = j.pair + 1)"""


@_register(f"""WITH RECURSIVE {_LEAVES},
every AS (SELECT tree, CASE WHEN ref THEN 'R' ELSE 'Q' END AS label FROM ranked UNION ALL SELECT tree, label FROM cherries WHERE n = 2 UNION ALL SELECT tree, label FROM joined WHERE pair > 0)
SELECT tree, label, count(*) AS n FROM every GROUP BY tree, label""")
def tree_labels(spark, d):
    return trees.label_nodes(_gene_trees(spark, d), "tree").groupBy("tree", "label").agg(F.count("*").alias("n"))


@_register(f"""WITH RECURSIVE {_LEAVES},
size AS (SELECT tree, count(*) AS n_pairs, sum(n) AS n_leaves, min(top) AS top FROM cherries GROUP BY tree),
marks AS (SELECT j.tree, j.pair, j.label, s.n_pairs, s.n_leaves, s.top FROM joined j JOIN size s USING (tree)),
s_nodes AS (SELECT tree, sum(CAST(x AS INTEGER)) AS n, bool_or(weak) AS weak FROM (SELECT tree, label = 'S' AS x, support < 80 AS weak FROM cherries WHERE n = 2
  UNION ALL SELECT tree, label = 'S', top < 80 FROM marks WHERE pair > 0) z GROUP BY tree),
sound AS (SELECT c.tree, c.pair, c.a, c.b FROM cherries c JOIN size s USING (tree) JOIN s_nodes n USING (tree)
  WHERE c.n = 2 AND c.label = 'S' AND c.support >= 80 AND s.n_pairs > 1 AND NOT (s.n_leaves = 4 AND n.n = 3 AND n.weak)
  AND NOT EXISTS (SELECT 1 FROM marks m WHERE m.tree = c.tree AND m.pair >= c.pair AND m.pair > 0 AND m.pair < s.n_pairs - 1 AND (m.label = 'P' OR m.top < 80))),
named AS (SELECT tree, CASE WHEN a LIKE '#R#%' THEN a ELSE b END AS reference, CASE WHEN a LIKE '#R#%' THEN b ELSE a END AS query FROM sound)
SELECT tree, reference, query FROM named QUALIFY count(*) OVER (PARTITION BY tree, split_part(query, '#', 1)) = 1""")
def tree_pairs(spark, d):
    return trees.tree_pairs(_gene_trees(spark, d), "tree", 80)


@_register(f"""WITH RECURSIVE {X.EDGES}, {X.COMPONENTS}
SELECT comp AS clique, node AS member FROM comp WHERE comp IN (SELECT c.comp FROM edges e JOIN comp c ON e.r = c.node WHERE e.weight < 20)""")
def restored_cliques(spark, d):
    edges = X.edges(spark, d)
    return trees.restored_cliques(edges, edges.filter("weight < 20").select(F.col("r").alias("gene")))


@_register(f"""WITH {X.EDGES}, sure AS (SELECT r, q FROM edges WHERE weight >= 900)
SELECT r, q, true AS settled FROM sure UNION ALL SELECT r, q, false FROM edges WHERE r NOT IN (SELECT r FROM sure) AND q NOT IN (SELECT q FROM sure)""")
def settled_pairs(spark, d):
    edges = X.edges(spark, d)
    return trees.settle_pairs(edges, edges.filter("weight >= 900").selectExpr("r AS reference", "q AS query"))


_LOCI = """SELECT l_orderkey AS tx, l_orderkey % 7 AS chain, CAST(l_linenumber AS INT) AS exon, l_orderkey % 2 = 0 AS codirected,
  CASE WHEN min(l_suppkey) % 3 > 0 THEN CASE WHEN l_orderkey % 2 = 0 THEN 500 + l_linenumber * 180 ELSE 2500 - l_linenumber * 180 END + min(l_partkey) % 150 END AS q_start,
  CASE WHEN min(l_suppkey) % 3 > 0 THEN CASE WHEN l_orderkey % 2 = 0 THEN 500 + l_linenumber * 180 ELSE 2500 - l_linenumber * 180 END + min(l_partkey) % 150 + CAST(min(l_quantity) AS BIGINT) * 2 END AS q_end
  FROM lineitem GROUP BY l_orderkey, l_linenumber"""


@_register(f"""WITH e AS ({_LOCI}),
rows_ AS (SELECT *, greatest(q_start - CASE WHEN codirected THEN 50 ELSE 30 END, 0) AS s0, q_end + CASE WHEN codirected THEN 30 ELSE 50 END AS e0 FROM e),
m AS (SELECT *, CASE WHEN s0 - max(e0) OVER (PARTITION BY tx, chain ORDER BY s0, e0, exon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 10 THEN 0 ELSE 1 END AS new FROM rows_ WHERE q_start IS NOT NULL),
i AS (SELECT *, sum(new) OVER (PARTITION BY tx, chain ORDER BY s0, e0, exon) AS island FROM m),
t AS (SELECT *, CASE WHEN lag(e0) OVER w IS NULL THEN s0 ELSE least(q_start, greatest(s0, lag(e0) OVER w + 1)) END AS s_start,
  CASE WHEN lead(s0) OVER w IS NULL THEN e0 ELSE greatest(q_end, least(e0, lead(s0) OVER w - 1)) END AS s_end FROM i WINDOW w AS (PARTITION BY tx, chain, island ORDER BY s0, e0, exon)),
g AS (SELECT tx, chain, island, min(exon) AS low, max(exon) AS high, min(s_start) AS g_start, max(s_end) AS g_end FROM t GROUP BY tx, chain, island),
joined AS (SELECT r.tx, r.chain, r.exon, g.low, g.g_start, g.g_end FROM rows_ r JOIN g ON r.tx = g.tx AND r.chain = g.chain AND g.low < r.exon AND r.exon < g.high WHERE r.q_start IS NULL
  QUALIFY row_number() OVER (PARTITION BY r.tx, r.chain, r.exon ORDER BY CASE WHEN r.codirected THEN g.island ELSE -g.island END) = 1),
alone AS (SELECT tx, chain, exon, codirected, exon - row_number() OVER (PARTITION BY tx, chain ORDER BY exon) AS run FROM rows_ r WHERE q_start IS NULL AND NOT EXISTS (SELECT 1 FROM joined j WHERE j.tx = r.tx AND j.chain = r.chain AND j.exon = r.exon)),
runs AS (SELECT tx, chain, run, codirected, min(exon) AS a, max(exon) AS b FROM alone GROUP BY tx, chain, run, codirected),
edge AS (SELECT tx, chain, min(exon) AS lo, max(exon) AS hi FROM e GROUP BY tx, chain),
own AS (SELECT t.tx, t.chain, t.exon, g.low, g.g_start, g.g_end, t.s_start, t.s_end FROM t JOIN g USING (tx, chain, island)),
beside AS (SELECT r.*, edge.lo, edge.hi, (SELECT arg_max(g_end, exon) FROM own o WHERE o.tx = r.tx AND o.chain = r.chain AND o.exon < r.a) AS p_end, (SELECT arg_max(g_start, exon) FROM own o WHERE o.tx = r.tx AND o.chain = r.chain AND o.exon < r.a) AS p_start,
  (SELECT arg_min(g_end, exon) FROM own o WHERE o.tx = r.tx AND o.chain = r.chain AND o.exon > r.b) AS n_end, (SELECT arg_min(g_start, exon) FROM own o WHERE o.tx = r.tx AND o.chain = r.chain AND o.exon > r.b) AS n_start FROM runs r JOIN edge USING (tx, chain)),
placed AS (SELECT *, CASE WHEN codirected THEN CASE WHEN a = lo THEN 0 ELSE p_end + 1 END ELSE CASE WHEN b = hi THEN 0 ELSE n_end + 1 END END AS g_start,
  CASE WHEN codirected THEN CASE WHEN b = hi THEN 4000 ELSE n_start - 1 END ELSE CASE WHEN a = lo THEN 4000 ELSE p_start - 1 END END AS g_end FROM beside)
SELECT tx, chain, exon, low AS first_exon, g_start, g_end, s_start, s_end FROM own
UNION ALL SELECT tx, chain, exon, low, g_start, g_end, NULL, NULL FROM joined
UNION ALL SELECT al.tx, al.chain, al.exon, p.a, p.g_start, p.g_end, NULL, NULL FROM alone al JOIN placed p USING (tx, chain, run)""")
def exon_grouping(spark, d):
    lines = X.table(spark, d, "lineitem")
    exons = spark.sql(_LOCI.replace("FROM lineitem", "FROM {lines}"), lines=lines)
    regions = exons.select("tx", "chain").distinct().selectExpr("tx", "chain", "CAST(0 AS BIGINT) AS start", "CAST(4000 AS BIGINT) AS stop")
    return grouping.exon_groups(exons, regions, 50, 30)


# the lines of an order in up to three fragments, which share exons at their borders
_FRAGMENTS = "SELECT l_orderkey AS tx, l_partkey % 3 AS chain, CAST(l_linenumber + l_suppkey % 4 AS INT) AS exon, CAST(max(l_quantity) AS BIGINT) % 20 AS covered FROM lineitem GROUP BY ALL"


@_register(f"""WITH RECURSIVE found AS ({_FRAGMENTS}),
ord AS (SELECT tx, chain, row_number() OVER (PARTITION BY tx ORDER BY min(exon), max(exon), chain) AS i, list(struct_pack(x := exon, c := covered) ORDER BY exon) AS l FROM found GROUP BY tx, chain),
walk(tx, i, chain, l, left_chain, left_l) AS (SELECT tx, i, chain, l, NULL::BIGINT, NULL::STRUCT(x INTEGER, c BIGINT)[] FROM ord WHERE i = 1
  UNION ALL SELECT tx, i, chain, list_filter(nl, lambda e: NOT list_contains(own, e.x) OR (cut IS NOT NULL AND e.x >= cut)), was, list_filter(l, lambda e: NOT list_contains(own, e.x) OR cut IS NULL OR e.x < cut)
  FROM (SELECT *, list_min(list_transform(list_filter(shared, lambda e: NOT ((e.c > list_filter(nl, lambda z: z.x = e.x)[1].c AND len(nl) <> 1) OR len(l) = 1)), lambda e: e.x)) AS cut, list_transform(shared, lambda e: e.x) AS own
    FROM (SELECT w.tx, o.i, o.chain, w.chain AS was, w.l, o.l AS nl, list_filter(w.l, lambda e: list_contains(list_transform(o.l, lambda z: z.x), e.x)) AS shared FROM walk w JOIN ord o ON o.tx = w.tx AND o.i = w.i + 1) a) b),
kept AS (SELECT tx, left_chain AS chain, unnest(left_l) AS e FROM walk WHERE i > 1 UNION ALL SELECT w.tx, w.chain, unnest(w.l) FROM walk w WHERE i = (SELECT max(o.i) FROM ord o WHERE o.tx = w.tx))
SELECT tx, chain, e.x AS exon, e.c AS covered FROM kept""")
def fragment_exons(spark, d):
    return grouping.shared_exons(spark.sql(_FRAGMENTS.replace("FROM lineitem", "FROM {lines}"), lines=X.table(spark, d, "lineitem")))


@_register("""WITH RECURSIVE alts AS (SELECT DISTINCT l_orderkey AS tx, l_linenumber % 4 AS grp, l_partkey % 3 AS alt FROM lineitem),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY tx ORDER BY grp) AS i FROM alts),
way(tx, i, path) AS (SELECT tx, i, [alt] FROM ranked WHERE i = 1 UNION ALL SELECT r.tx, r.i, list_append(w.path, r.alt) FROM way w JOIN ranked r ON r.tx = w.tx AND r.i = w.i + 1),
whole AS (SELECT tx, path, row_number() OVER (PARTITION BY tx ORDER BY path) AS combination FROM way w WHERE i = (SELECT max(i) FROM ranked r WHERE r.tx = w.tx)),
names AS (SELECT DISTINCT tx, grp, i FROM ranked)
SELECT tx, combination, grp, path[i] AS alt FROM whole JOIN names USING (tx)""")
def group_combinations(spark, d):
    rows = X.table(spark, d, "lineitem").selectExpr("l_orderkey AS tx", "l_linenumber % 4 AS grp", "l_partkey % 3 AS alt")
    return grouping.group_combinations(rows, ["tx"], "grp", "alt")
