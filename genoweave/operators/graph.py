"""Graph operators over edge tables: components, bipartite classes, completeness, leaf edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.session import discard, written


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Map every vertex of ``edges`` to the smallest vertex that it can reach.

    Returns (vertex, root), roots included. Each round links every vertex's larger neighbours to
    its least neighbour (large star), then every vertex's smaller ones (small star); a round is two
    aggregations with map-side combine and two equi-joins, so a hub vertex is never gathered in one
    task, and the number of rounds grows with the logarithm of the diameter. A round is one written
    table, which replaces the one before. Rounds end when all edges point from a vertex to a root, which
    is so when edges and roots together are as many as vertices. Self loops and null ends are ignored;
    an empty table gives an empty result.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    e = written(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    vertices = e.select(F.explode(F.array("a", "b")).alias("v")).distinct().count()
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least_neighbour(both).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # every pair now points downwards: a > b
        small = (
            large.join(_least_neighbour(large), "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("p"))
            .select("p.a", "p.b")
            .filter("a <> b")
            .distinct()
        )
        after = written(small, "components")
        discard(e)
        e = after
        found = e.agg(F.count("*").alias("n"), F.countDistinct("b").alias("roots")).first()
        if found["n"] + found["roots"] == vertices:
            break
    leaves = e.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("vertex"), "root").distinct())


def bipartite_components(edges: DataFrame, r: str = "r", q: str = "q") -> DataFrame:
    """``connected_components`` of edges between two kinds of vertices that have no name in common.

    Every r links its q to the least of them, so rounds move the links between q only; an r follows its least q.
    Links of an r with many q meet in an equi-join after an aggregation, as in a round.
    """
    pairs = edges.select(F.col(r).alias("r"), F.col(q).alias("q")).filter("r IS NOT NULL AND q IS NOT NULL")
    least = written(pairs.groupBy("r").agg(F.min("q").alias("m")), "least-ends")
    roots = connected_components(pairs.join(least, "r").filter("q <> m"), "q", "m")
    held = written(least.join(roots, F.col("m") == F.col("vertex"), "left").select("r", "m", "root"), "held-ends")
    discard(least)
    mine = held.select(F.col("r").alias("vertex"), F.coalesce("root", "m").alias("root"))
    # a q that no r links to another one is its own root
    alone = held.filter("root IS NULL").select(F.col("m").alias("vertex"), F.col("m").alias("root")).distinct()
    low = mine.groupBy("root").agg(F.min("vertex").alias("low")).filter("low < root")
    found = mine.unionByName(alone).unionByName(roots).join(low, "root", "left")
    return found.select("vertex", F.coalesce("low", "root").alias("root"))


def orthology_classes(edges: DataFrame, nodes: DataFrame | None = None, roots: DataFrame | None = None) -> DataFrame:
    """(comp, n_ref, n_query, n_edges, class, complete) of a bipartite (r, q) edge table.

    ``nodes`` (r) adds reference genes without an edge, which are one2zero. A component is complete
    if every reference gene of it has an edge to every query gene. ``roots`` are the components of
    the edges where they are known already.
    """
    if roots is None:
        roots = connected_components(edges, "r", "q")
    # a gene is in one component, so genes are counted by themselves first, each with one row
    pairs = edges.select("r", "q").distinct()
    query = pairs.groupBy(F.col("q").alias("gene")).agg(F.count("*").alias("n")).withColumn("ref", F.lit(False))
    ref = pairs.select(F.col("r").alias("gene")).distinct().select("gene", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("ref"))
    member = query.unionByName(ref).join(roots, F.col("gene") == F.col("vertex"))
    found = member.groupBy(F.col("root").alias("comp")).agg(F.count_if("ref").alias("n_ref"), F.count_if(~F.col("ref")).alias("n_query"), F.sum("n").alias("n_edges"))
    if nodes is not None:
        alone = nodes.select("r").distinct().join(edges, "r", "left_anti")
        found = found.unionByName(alone.select(F.col("r").alias("comp"), F.lit(1).cast("bigint").alias("n_ref"), F.lit(0).cast("bigint").alias("n_query"), F.lit(0).cast("bigint").alias("n_edges")))
    kind = (
        F.when(F.col("n_query") == 0, "one2zero")
        .when((F.col("n_ref") == 1) & (F.col("n_query") == 1), "one2one")
        .when(F.col("n_ref") == 1, "one2many")
        .when(F.col("n_query") == 1, "many2one")
        .otherwise("many2many")
    )
    return found.select("comp", "n_ref", "n_query", "n_edges", kind.alias("class"), (F.col("n_edges") == F.col("n_ref") * F.col("n_query")).alias("complete"))


def removable_leaf_edges(edges: DataFrame) -> DataFrame:
    """(r, q, weight, comp) of leaf edges that a many2many component can drop.

    A leaf edge has an end of degree one. A component's leaves go if it keeps a core and either all
    of them weigh under 0.75 or the heaviest weighs at most 0.9 of the lightest edge kept. Weights
    are whole thousandths.
    """
    roots = connected_components(edges, "r", "q")
    e = edges.join(roots, F.col("q") == F.col("vertex")).select("r", "q", "weight", F.col("root").alias("comp"))
    dr, dq = e.groupBy("r").agg(F.count("*").alias("dr")), e.groupBy("q").agg(F.count("*").alias("dq"))
    e = e.join(dr, "r").join(dq, "q").withColumn("leaf", (F.col("dr") == 1) | (F.col("dq") == 1))
    rule = e.groupBy("comp").agg(
        F.countDistinct("r").alias("nr"),
        F.countDistinct("q").alias("nq"),
        F.max(F.when(F.col("leaf"), F.col("weight"))).alias("top_leaf"),
        F.min(F.when(~F.col("leaf"), F.col("weight"))).alias("low_core"),
    )
    drop = rule.filter("nr > 1 and nq > 1 and top_leaf is not null and low_core is not null")
    drop = drop.filter("top_leaf < 750 or top_leaf * 10 <= low_core * 9").select("comp")
    return e.filter("leaf").join(drop, "comp", "left_semi").select("r", "q", "weight", "comp")
