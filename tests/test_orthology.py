"""Orthology classes and tables count genes by themselves and move projections once."""

import random

from genoweave.operators import graph as G
from genoweave.operators import results as R
from genoweave.plans import results


def test_classes_of_odd_edges(spark):
    """Repeated edges, a name on both sides, an edge to itself and null ends, against sets."""
    edges = [("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", "z"), ("z", "w"), ("z", "z"), ("u", "u"), (None, "x"), ("d", None)]
    got = {r["comp"]: (r["n_ref"], r["n_query"], r["n_edges"], r["class"], r["complete"]) for r in G.orthology_classes(spark.createDataFrame(edges, "r string, q string")).collect()}
    # an edge with a null end counts where its query gene is known
    assert got == {"a": (2, 2, 4, "many2many", True), "c": (2, 2, 3, "many2many", False)}


def test_projections_with_their_genes_need_no_second_table(spark):
    members = spark.createDataFrame([("a", "one2many", g) for g in "axy"] + [("b", "one2one", g) for g in "bz"] + [("c", "one2zero", "c")], "comp string, class string, gene string")
    isoforms = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "r string, tx long")
    rows = [(1, "1#1", "x"), (1, "1#2", "z"), (2, "2#1", "y"), (3, "3#1", "z"), (3, "3#2", None), (9, "9#1", "x")]
    found = spark.createDataFrame(rows, "tx long, proj string, q string")
    want = {("a", 1, "x", "1#1", "one2many"), ("a", 2, "y", "2#1", "one2many"), ("b", 3, "z", "3#1", "one2one"), ("c", 4, None, None, "one2zero")}
    assert {tuple(r) for r in R.orthology_table(members, isoforms, found).collect()} == want
    assert {tuple(r) for r in R.orthology_table(members, isoforms, found.select("tx", "proj"), found.select("proj", "q")).collect()} == want


def test_the_table_shuffles_projections_for_two_joins_only(spark, capsys):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results.QUERIES["orthology_table"](spark, "/root/testdata/sf0.001").explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x]
    assert len([x for x in exchanges if "proj#" in x.split("],")[0].split("hashpartitioning(")[1].split("), ")[0]]) == 0


def test_components_by_the_lesser_side(spark):
    """Roots are the least names of whole components, whichever side has them; a pair alone, null ends, repeated edges."""
    rng = random.Random(2)
    for left, right in (("r", "x"), ("x", "r")):
        edges = [(f"{left}{rng.randrange(60):02}", f"{right}{rng.randrange(70):02}") for _ in range(55)] + [(f"{left}{i}", f"{right}hub") for i in range(200, 260)]
        edges += [(f"{left}a", f"{right}a"), (f"{left}b", f"{right}b"), (f"{left}b", f"{right}b"), (None, f"{right}c"), (f"{left}d", None)]
        df = spark.createDataFrame(edges, "r string, q string")
        want = {tuple(x) for x in G.connected_components(df, "r", "q").collect()}
        got = [tuple(x) for x in G.bipartite_components(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want
