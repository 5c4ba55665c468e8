"""Biconnected components of edge tables: spanning forest, Euler tours, low and high links; no large component meets in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators import local
from genoweave.operators.graph import connected_components
from genoweave.session import discard, partitions, written

BINS = 64  # parts of the neighbours of a vertex that are ordered by themselves
SMALL = 1 << 18  # edges up to which a component is walked in one task


def _plain(edges: DataFrame, a: str, b: str) -> DataFrame:
    rows = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b")
    return written(rows.distinct(), "edges")


def _numbered(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges by numbers of their vertices, in the order of the names, and (name, n): rounds move eight bytes for a name."""
    vertices = e.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    names = written(vertices.orderBy("name").withColumn("n", F.monotonically_increasing_id()), "vertex-names")
    at = lambda c: names.select(F.col("name").alias(c), F.col("n").alias(f"{c}_n"))
    rows = written(e.join(at("a"), "a").join(at("b"), "b").select(F.col("a_n").alias("a"), F.col("b_n").alias("b")), "edges")
    discard(e)
    return rows, names


def _renamed(rows: DataFrame, names: DataFrame, *columns: str) -> DataFrame:
    """The rows with names in the place of numbers; nulls stay."""
    for c in columns:
        rows = rows.join(names.select(F.col("n").alias(c), F.col("name").alias("_name")), c, "left").withColumn(c, F.col("_name")).drop("_name")
    return rows


def _last(hops: DataFrame, label: str) -> DataFrame:
    """hops (c, p), without cycles -> (c, p) with p the last vertex that hops lead to; rounds are logarithmic."""
    at, table = hops, None
    while True:
        ahead = at.select(F.col("c").alias("p"), F.col("p").alias("far"))
        twice = at.join(ahead, "p", "left").select("c", F.coalesce("far", "p").alias("p"), F.col("far").isNotNull().alias("moved"))
        before, table = table, written(twice, label)
        if before is not None:
            discard(before)
        if table.filter("moved").isEmpty():
            return table.select("c", "p")
        at = table.drop("moved")


def spanning_forest(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges (a, b) of a spanning forest of distinct edges a < b, and (vertex, root) with the smallest vertex as root.

    Every round, each component with a smaller neighbour hooks onto the smallest, by one edge, and the
    edges left are those between the components that this made.
    """
    left = e.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"))
    root, forest = e.select(F.explode(F.array("a", "b")).alias("vertex")).distinct().withColumn("root", F.col("vertex")), None
    while True:
        low, high = F.least("ca", "cb"), F.greatest("ca", "cb")
        hooks = left.groupBy(high.alias("c")).agg(F.min(F.struct(low.alias("p"), F.col("a"), F.col("b"))).alias("h"))
        hooks = written(hooks.select("c", "h.p", "h.a", "h.b"), "hooks")
        forest = hooks.select("a", "b") if forest is None else forest.unionByName(hooks.select("a", "b"))
        last = _last(hooks.select("c", "p"), "hook-roots")
        root = root.join(last.withColumnRenamed("c", "root"), "root", "left").select("vertex", F.coalesce("p", "root").alias("root"))
        to = lambda c: last.select(F.col("c").alias(c), F.col("p").alias(f"new_{c}"))
        moved = left.join(to("ca"), "ca", "left").join(to("cb"), "cb", "left").select("a", "b", F.coalesce("new_ca", "ca").alias("ca"), F.coalesce("new_cb", "cb").alias("cb"))
        before, left = left, written(moved.filter("ca <> cb"), "edges-left")
        if hasattr(before, "written_to"):
            discard(before)
        if left.isEmpty():
            return forest, written(root, "tree-roots")


def _next_neighbours(arcs: DataFrame) -> DataFrame:
    """arcs (v, u) -> (v, u, w, last): w follows u among the neighbours of v, null behind the last; first is v's first one.

    Neighbours are ordered in ``BINS`` parts, so a hub is never sorted in one task.
    """
    bins = arcs.withColumn("bin", F.pmod(F.xxhash64("u"), F.lit(BINS)).cast("int"))
    inside = Window.partitionBy("v", "bin").orderBy("u")
    firsts = bins.groupBy("v", "bin").agg(F.min("u").alias("first"))
    along = Window.partitionBy("v").orderBy("bin")
    firsts = firsts.select("v", "bin", F.lead("first").over(along).alias("next_bin"), F.first("first").over(along).alias("first"))
    return bins.withColumn("w", F.lead("u").over(inside)).join(firsts, ["v", "bin"]).select("v", "u", F.coalesce("w", "next_bin").alias("w"), "first")


def euler_tours(forest: DataFrame, roots: DataFrame) -> DataFrame:
    """forest (a, b), roots (vertex, root) -> (vertex, parent, root, t_in, t_out): places of the arcs into and out of each vertex in its tree's tour.

    Roots are the smallest vertices and have no parent. Tours are ranked by pointer doubling, so the
    number of rounds is the logarithm of the longest tour.
    """
    arcs = forest.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(forest.select(F.col("b").alias("v"), F.col("a").alias("u")))
    linked = _next_neighbours(arcs).join(roots, F.col("v") == F.col("vertex"))
    # the arc u -> v goes on to v's next neighbour, from its last one to its first, but ends at the root
    turn = F.coalesce("w", F.when(F.col("v") != F.col("root"), F.col("first")))
    at = linked.select("root", F.col("u").alias("x"), F.col("v").alias("y"), F.when(turn.isNotNull(), F.col("v")).alias("sx"), turn.alias("sy"), F.lit(1).cast("bigint").alias("d"))
    at = written(at, "tour")
    while not at.filter("sy IS NOT NULL").isEmpty():
        before = at
        ahead = at.select(F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("sx").alias("tx"), F.col("sy").alias("ty"), F.col("d").alias("more"))
        for _ in range(2):  # three times as far in a round
            at = at.join(ahead, ["sx", "sy"], "left").select("root", "x", "y", F.col("tx").alias("sx"), F.col("ty").alias("sy"), (F.col("d") + F.coalesce("more", F.lit(0))).alias("d"))
        at = written(at, "tour")
        discard(before)
    size = at.groupBy("root").agg(F.max("d").alias("n"))
    places = at.join(size, "root").select("root", "x", "y", (F.col("n") - F.col("d")).alias("t"))
    both = places.groupBy("root", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).agg(
        F.min(F.struct("t", F.col("x").alias("parent"), F.col("y").alias("vertex"))).alias("down"), F.max("t").alias("t_out")
    )
    inner = both.select("down.vertex", "down.parent", "root", F.col("down.t").alias("t_in"), "t_out")
    top = size.select(F.col("root").alias("vertex"), F.lit(None).cast(forest.schema["a"].dataType).alias("parent"), "root", F.lit(-1).cast("bigint").alias("t_in"), F.col("n").alias("t_out"))
    tree = written(inner.unionByName(top), "tree")
    discard(at)
    return tree


def _subtree_ends(tree: DataFrame, own: DataFrame) -> DataFrame:
    """own (vertex, root, t_in, t_out, lo, hi) -> (vertex, low, high): least lo and largest hi in each subtree.

    A subtree is a stretch of the tour. Tables of the extremes of 1, 2, 4, .. places give every
    stretch by two of them that overlap.
    """
    level = written(own.select("root", F.col("t_in").alias("t"), "lo", "hi"), "extremes")
    longest = own.agg(F.max(F.col("t_out") - F.col("t_in") + 1)).first()[0] or 1
    levels, j = [level.withColumn("j", F.lit(0))], 0
    while 2 << j <= longest:
        step = 1 << j
        both = level.unionByName(level.withColumn("t", F.col("t") - step))
        level = written(both.groupBy("root", "t").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "extremes")
        j += 1
        levels.append(level.withColumn("j", F.lit(j)))
    table = levels[0]
    for more in levels[1:]:
        table = table.unionByName(more)
    k = F.length(F.bin(F.col("t_out") - F.col("t_in") + 1)) - 1
    places = F.array(F.col("t_in"), F.expr("t_out + 1 - shiftleft(1L, j)"))
    asked = own.withColumn("j", k).select("vertex", "root", "j", F.explode(places).alias("t"))
    return asked.join(table, ["root", "j", "t"]).groupBy("vertex").agg(F.min("lo").alias("low"), F.max("hi").alias("high"))


def biconnected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b, block) for every edge, a < b: edges of one block lie on a common cycle, a bridge is alone.

    A tree edge is named by its lower end. Two tree edges share a block if an edge between their
    ends' subtrees crosses, or if the lower one's subtree reaches beyond the upper one's; blocks are the
    components of these links. Self loops, null ends and repeated edges are ignored; every step is a
    join or an aggregate by vertex or place, and rounds grow with the logarithm of the largest tree.
    """
    _, of_edge, names = _blocks(edges, a, b)
    return _renamed(of_edge, names, "a", "b", "block").select("a", "b", "block")


def _blocks(edges: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e, names = _numbered(_plain(edges, a, b))
    return (*_blocks_of(e), names)


def _blocks_of(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    kind = e.schema["a"].dataType
    if e.isEmpty():
        none = e.withColumn("block", F.lit(None).cast(kind))
        return none.select(F.col("a").alias("vertex"), F.lit(None).cast(kind).alias("parent")), none
    tree = euler_tours(*spanning_forest(e))
    end = lambda name: tree.select(F.col("vertex").alias(name), F.col("parent").alias(f"{name}_up"), F.col("t_in").alias(f"{name}_in"), F.col("t_out").alias(f"{name}_out"))
    known = written(e.join(end("a"), "a").join(end("b"), "b"), "known-edges")
    upward = lambda x, y: F.coalesce(F.col(f"{x}_up") == F.col(y), F.lit(False))
    other = known.filter(~(upward("a", "b") | upward("b", "a")))
    reach = other.select(F.col("a").alias("vertex"), F.col("b_in").alias("t")).unionByName(other.select(F.col("b").alias("vertex"), F.col("a_in").alias("t")))
    reach = reach.groupBy("vertex").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    own = tree.join(reach, "vertex", "left").select("vertex", "root", "t_in", "t_out", F.least("t_in", "lo").alias("lo"), F.greatest("t_in", "hi").alias("hi"))
    ends = _subtree_ends(tree, own)
    above = tree.select(F.col("vertex").alias("parent"), F.col("parent").alias("over"), F.col("t_in").alias("p_in"), F.col("t_out").alias("p_out"))
    beyond = tree.join(ends, "vertex").join(above, "parent").filter("over IS NOT NULL AND (low < p_in OR high > p_out)")
    apart = other.filter("NOT (a_in < b_in AND b_in < a_out) AND NOT (b_in < a_in AND a_in < b_out)")
    links = beyond.select(F.col("vertex").alias("x"), F.col("parent").alias("y")).unionByName(apart.select(F.col("a").alias("x"), F.col("b").alias("y")))
    group = connected_components(links, "x", "y")
    named = tree.filter("parent IS NOT NULL").join(group.select("vertex", F.col("root").alias("block")), "vertex", "left")
    named = written(named.select("vertex", "parent", F.coalesce("block", "vertex").alias("block")), "blocks")
    # an edge belongs to the block of its end that comes later in the tour
    lower = F.when(F.col("a_in") > F.col("b_in"), F.col("a")).otherwise(F.col("b"))
    of_edge = known.select("a", "b", lower.alias("vertex")).join(named.select("vertex", "block"), "vertex").select("a", "b", "block")
    return named, of_edge


def _by_component(edges: DataFrame, a: str, b: str, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(g, a, b) of the edges in components of up to ``small`` edges, repeats included, (a, b) of all others, and the table of both.

    Components are found over hashes of 40 bits, so that rounds move little; names with one hash may put two
    components together, which parts no component.
    """
    named = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b")
    hashed = lambda c: F.shiftrightunsigned(F.xxhash64(c), 24)
    rows = written(named.withColumn("h", hashed("a")), "hashed-edges")
    root = connected_components(rows.select(F.col("h").alias("a"), hashed("b").alias("b")))
    # an end that shares its hash with the other one may be in no link
    placed = rows.join(root, rows["h"] == root["vertex"], "left").select(F.coalesce("root", "h").alias("g"), "a", "b")
    placed = written(placed, "edges")
    discard(rows)
    large = written(placed.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > small).select("g"), "large-components")
    if large.isEmpty():
        return placed, placed.limit(0).select("a", "b"), placed
    # each has many edges, so they are few
    return placed.join(F.broadcast(large), "g", "left_anti"), placed.join(F.broadcast(large), "g", "left_semi").select("a", "b"), placed


def _walked(rows: DataFrame, fold: Callable[[pa.Array, np.ndarray, np.ndarray], list], schema: str) -> DataFrame:
    """rows (g, a, b): the columns that ``fold(names, x, y)`` makes of whole groups, names in order and edges as numbers of them."""

    def folded(table: pa.Table) -> pa.RecordBatch:
        ends = pa.chunked_array([*table["a"].chunks, *table["b"].chunks]).combine_chunks()
        ends = (ends if isinstance(ends, pa.Array) else pa.concat_arrays(ends.chunks)).dictionary_encode()
        order = pc.array_sort_indices(ends.dictionary)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        code = rank[ends.indices.to_numpy()]
        return pa.RecordBatch.from_arrays(fold(ends.dictionary.take(order), code[: len(table)], code[len(table) :]), [f.split()[0] for f in schema.split(",")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            g = batch["g"].to_numpy()
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1]))
            # what is held has one group, which may go on
            if held and g[0] != held[0]["g"][0].as_py():
                yield folded(pa.Table.from_batches(held))
                held = []
            if cut:
                yield folded(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield folded(pa.Table.from_batches(held))

    return rows.repartition(partitions(rows.sparkSession), "g").sortWithinPartitions("g").mapInArrow(run, schema)


def block_counts(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many blocks hold each of the vertices 0 .. n - 1, with edges x[k], y[k]; a walk in depth, vertex by vertex."""
    src = np.concatenate([x, y])
    to = np.concatenate([y, x])[np.argsort(src, kind="stable")].tolist()
    ends = np.cumsum(np.bincount(src, minlength=n)).tolist()
    at = [0, *ends[:-1]]
    seen, low, up, held, now = [0] * n, [0] * n, [-1] * n, [0] * n, 0
    for top in range(n):
        if seen[top]:
            continue
        now += 1
        seen[top] = low[top] = now
        path = [top]
        while path:
            v = path[-1]
            if at[v] < ends[v]:
                w = to[at[v]]
                at[v] += 1
                if not seen[w]:
                    now += 1
                    seen[w] = low[w] = now
                    up[w], held[w] = v, 1  # the block of the edge to it
                    path.append(w)
                elif w != up[v] and seen[w] < low[v]:
                    low[v] = seen[w]
            else:
                path.pop()
                u = up[v]
                if u >= 0:
                    low[u] = min(low[u], low[v])
                    held[u] += low[v] >= seen[u]  # v is the first vertex of a block of u
    return np.array(held, dtype=np.int64)


def _points(names: pa.Array, x: np.ndarray, y: np.ndarray) -> list:
    held = block_counts(len(names), x, y)
    cut = np.flatnonzero(held > 1)
    return [names.take(pa.array(cut)), pa.array(held[cut])]


def _split(names: pa.Array, x: np.ndarray, y: np.ndarray) -> list:
    cut = block_counts(len(names), x, y) > 1
    kept = ~(cut[x] | cut[y])
    root = local.components(len(names), x[kept], y[kept])
    return [names, pa.array(cut), names.take(pa.array(root, mask=cut))]


def articulation_points(edges: DataFrame, a: str = "a", b: str = "b", small: int = SMALL) -> DataFrame:
    """(vertex, n_blocks): vertices whose loss splits their component, and into how many parts.

    Such a vertex has edges in several blocks: its own tree edge's and those of its children. Components of up to
    ``small`` edges are walked in one task each, larger ones by ``biconnected_components``' steps.
    """
    few, many, both = _by_component(edges, a, b, small)
    found = _walked(few, _points, f"vertex {both.schema['a'].dataType.simpleString()}, n_blocks bigint")
    if many.isEmpty():
        return found
    named, _, names = _blocks(many, "a", "b")
    return found.unionByName(_renamed(_cut(named), names, "vertex").select("vertex", "n_blocks"))


def _cut(named: DataFrame) -> DataFrame:
    if "block" not in named.columns:
        return named.select("vertex", F.lit(0).cast("bigint").alias("n_blocks"))
    held = named.select("vertex", "block").unionByName(named.select(F.col("parent").alias("vertex"), "block")).distinct()
    return held.groupBy("vertex").agg(F.count("*").alias("n_blocks")).filter("n_blocks > 1")


def split_chimeras(edges: DataFrame, a: str = "a", b: str = "b", small: int = SMALL) -> DataFrame:
    """(vertex, chimeric, root): articulation points are rejected, root null; the others are grouped anew without them.

    Vertices that are then alone are their own root. Components of up to ``small`` edges are walked in one task each.
    """
    few, many, both = _by_component(edges, a, b, small)
    kind = both.schema["a"].dataType.simpleString()
    found = _walked(few, _split, f"vertex {kind}, chimeric boolean, root {kind}")
    return found if many.isEmpty() else found.unionByName(_split_large(many))


def _split_large(edges: DataFrame) -> DataFrame:
    e, names = _numbered(_plain(edges, "a", "b"))
    cut = written(_cut(_blocks_of(e)[0]).select("vertex"), "chimeras")
    ends = e.select(F.col("a").alias("vertex")).union(e.select("b")).distinct()
    kept = e.join(cut.withColumnRenamed("vertex", "a"), "a", "left_anti").join(cut.withColumnRenamed("vertex", "b"), "b", "left_anti")
    root = connected_components(kept)
    rows = ends.join(cut.withColumn("chimeric", F.lit(True)), "vertex", "left").join(root, "vertex", "left")
    chimeric = F.coalesce("chimeric", F.lit(False))
    found = rows.select("vertex", chimeric.alias("chimeric"), F.when(~chimeric, F.coalesce("root", "vertex")).alias("root"))
    return _renamed(found, names, "vertex", "root").select("vertex", "chimeric", "root")
