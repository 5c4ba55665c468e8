"""Search groups of exons by their expected loci, exons shared by fragments, and combinations of alternatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_INTRON = 10  # spaces that are no farther apart are one group


def exon_groups(exons: DataFrame, regions: DataFrame, acceptor: int = 50, donor: int = 50, gap: int = MIN_INTRON) -> DataFrame:
    """(tx, chain, exon, first_exon, g_start, g_end, s_start, s_end): the group of every exon, named by its first exon.

    exons (tx, chain, exon, codirected, q_start, q_end), the range null where an exon is missing;
    regions (tx, chain, start, stop), the search region of the projection. An exon's search space is its
    range with a flank on either side, the acceptor's before it in its own direction; spaces that
    overlap or are at most ``gap`` bases apart are a group, which reaches over all of them. In a group,
    neighbouring spaces are then trimmed so that they don't overlap, but never into an expected
    range. A missing exon between the first and last exon of a group joins it, of several the one
    that comes first in the exons' direction; other missing exons form runs of neighbours, which reach from the
    group before to the group behind, or to the end of the region. Such a run has no search spaces
    of its own exons; its group is empty (g_end < g_start) where no room is left. Windows are those of a projection.
    """
    c = F.col
    key = ["tx", "chain"]
    before, after = F.when(c("codirected"), acceptor).otherwise(donor), F.when(c("codirected"), donor).otherwise(acceptor)
    rows = exons.select(*key, "exon", "codirected", "q_start", "q_end", F.greatest(c("q_start") - before, F.lit(0)).alias("s0"), (c("q_end") + after).alias("e0"))
    there = rows.filter("q_start IS NOT NULL AND q_end IS NOT NULL")
    along = Window.partitionBy(*key).orderBy("s0", "e0", "exon")
    reach = F.max("e0").over(along.rowsBetween(Window.unboundedPreceding, -1))
    there = there.withColumn("new", F.when(c("s0") - reach <= gap, 0).otherwise(1)).withColumn("island", F.sum("new").over(along))
    inside = Window.partitionBy(*key, "island").orderBy("s0", "e0", "exon")
    trimmed_start = F.coalesce(F.least("q_start", F.greatest(c("s0"), F.lag("e0").over(inside) + 1)), c("s0"))
    trimmed_end = F.coalesce(F.greatest("q_end", F.least(c("e0"), F.lead("s0").over(inside) - 1)), c("e0"))
    whole = Window.partitionBy(*key, "island")
    there = there.select(
        *key, "exon", "codirected", "island", F.when(F.lag("e0").over(inside).isNull(), c("s0")).otherwise(trimmed_start).alias("s_start"), F.when(F.lead("s0").over(inside).isNull(), c("e0")).otherwise(trimmed_end).alias("s_end"),
        F.min("exon").over(whole).alias("low"), F.max("exon").over(whole).alias("high"),
    )
    # a group reaches from the first to the last of its spaces as they are after trimming
    there = there.withColumns({"g_start": F.min("s_start").over(whole), "g_end": F.max("s_end").over(whole)})
    islands = there.groupBy(*key, "island").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.first("g_start").alias("g_start"), F.first("g_end").alias("g_end"))
    lost = rows.filter("q_start IS NULL OR q_end IS NULL").select(*key, "exon", "codirected")
    near = lost.join(islands, key).filter("low < exon AND exon < high")
    turn = F.when(c("codirected"), c("island")).otherwise(-c("island"))
    joined = near.groupBy(*key, "exon", "codirected").agg(F.min_by(F.struct("island", "low", "g_start", "g_end"), turn).alias("g"))
    joined = joined.select(*key, "exon", "codirected", "g.island", "g.low", "g.g_start", "g.g_end")
    alone = lost.join(joined.select(*key, "exon"), [*key, "exon"], "left_anti")
    placed = there.select(*key, "exon", "codirected", "low", "g_start", "g_end", "s_start", "s_end", F.lit(True).alias("own"))
    placed = placed.unionByName(joined.select(*key, "exon", "codirected", "low", "g_start", "g_end").withColumn("own", F.lit(False)), allowMissingColumns=True)
    placed = placed.unionByName(alone.withColumn("own", F.lit(False)), allowMissingColumns=True)
    by_exon = Window.partitionBy(*key).orderBy("exon")
    free = c("low").isNull()
    starts = free & (~F.coalesce(F.lag(free).over(by_exon), F.lit(False)) | (F.lag("exon").over(by_exon) != c("exon") - 1))
    placed = placed.withColumn("run", F.sum(starts.cast("int")).over(by_exon))
    past, ahead = by_exon.rowsBetween(Window.unboundedPreceding, -1), by_exon.rowsBetween(1, Window.unboundedFollowing)
    defined = F.when(c("own"), F.struct("g_start", "g_end"))
    placed = placed.withColumns({"prev": F.last(defined, ignorenulls=True).over(past), "next": F.first(defined, ignorenulls=True).over(ahead)})
    # within a run no exon is defined, so all of its exons see the same neighbours
    run = Window.partitionBy(*key, "run", free)
    edge = Window.partitionBy(*key)
    placed = placed.join(regions.select(*key, "start", "stop"), key)
    placed = placed.withColumns({"head": F.min("exon").over(run), "last_one": F.max("exon").over(run), "e_min": F.min("exon").over(edge), "e_max": F.max("exon").over(edge)})
    at_first, at_last = c("head") == c("e_min"), c("last_one") == c("e_max")
    left = F.when(c("codirected"), F.when(at_first, c("start")).otherwise(c("prev.g_end") + 1)).otherwise(F.when(at_last, c("start")).otherwise(c("next.g_end") + 1))
    right = F.when(c("codirected"), F.when(at_last, c("stop")).otherwise(c("next.g_start") - 1)).otherwise(F.when(at_first, c("stop")).otherwise(c("prev.g_start") - 1))
    return placed.select(
        *key, "exon", F.coalesce("low", "head").alias("first_exon"), F.when(free, left).otherwise(c("g_start")).alias("g_start"), F.when(free, right).otherwise(c("g_end")).alias("g_end"), "s_start", "s_end"
    )


def shared_exons(found: DataFrame) -> DataFrame:
    """found (tx, chain, exon, covered) -> (tx, chain, exon, covered): every exon of a fragmented transcript left to one of two neighbours.

    The chains of a transcript are taken by their first, then their last exon (then by name), and each meets the next one once, as
    the pair before has left it. Of the exons that both have, in order, the former keeps those it covers better, up to the first that it
    doesn't; that one and all behind it are the latter's. A chain that has a single exon keeps it, the former before the latter. Chains that are
    no neighbours in this order may still share exons. Null coverage counts as 0, repeated rows
    as the best of them; a row holds the exons of one transcript.
    """
    best = found.groupBy("tx", "chain", "exon").agg(F.max(F.coalesce(F.col("covered").cast("bigint"), F.lit(0))).alias("covered"))
    kind = best.schema["chain"].dataType.simpleString()
    number = best.schema["exon"].dataType.simpleString()
    mappers = best.groupBy("tx", "chain").agg(F.array_sort(F.collect_list(F.struct("exon", "covered"))).alias("exons"), F.min("exon").alias("lo"), F.max("exon").alias("hi"))
    whole = mappers.groupBy("tx").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "chain", "exons"))).alias("f"))
    piece = f"struct<chain:{kind},exons:array<struct<exon:{number},covered:bigint>>>"
    state = f"struct<done:array<{piece}>,cur:{piece}>"
    plain = lambda x: F.struct(x["chain"].alias("chain"), x["exons"].alias("exons"))

    def settled(acc: Column, after: Column) -> Column:
        former, latter = acc["cur"]["exons"], after["exons"]
        theirs = F.map_from_entries(latter)
        contested = F.filter(former, lambda e: F.map_contains_key(theirs, e["exon"]))
        kept = lambda e: ((e["covered"] > theirs[e["exon"]]) & (F.size(latter) != 1)) | (F.size(former) == 1)
        cut = F.array_min(F.transform(F.filter(contested, lambda e: ~kept(e)), lambda e: e["exon"]))
        own = F.transform(contested, lambda e: e["exon"])
        left = F.filter(former, lambda e: ~(F.array_contains(own, e["exon"]) & F.coalesce(e["exon"] >= cut, F.lit(False))))
        right = F.filter(latter, lambda e: ~(F.array_contains(own, e["exon"]) & F.coalesce(e["exon"] < cut, F.lit(True))))
        done = F.concat(acc["done"], F.array(F.struct(acc["cur"]["chain"].alias("chain"), left.alias("exons"))))
        return F.struct(done.alias("done"), F.struct(after["chain"].alias("chain"), right.alias("exons")).alias("cur")).cast(state)

    start = F.struct(F.array().cast(f"array<{piece}>").alias("done"), plain(F.col("f")[0]).alias("cur")).cast(state)
    pieces = F.aggregate(F.slice("f", F.lit(2), F.size("f")), start, settled, lambda acc: F.concat(acc["done"], F.array(acc["cur"])))
    rows = whole.select("tx", F.explode(pieces).alias("p")).select("tx", "p.chain", F.explode("p.exons").alias("e"))
    return rows.select("tx", "chain", "e.exon", "e.covered")


def group_combinations(alternatives: DataFrame, key: list[str], group: str, alt: str) -> DataFrame:
    """(key..., combination, group, alt): every way to take one alternative of each group, numbered from 1.

    The first group changes slowest; groups and their alternatives are in order, equal ones count once,
    rows without a group or an alternative not at all. The numbers of a combination are the
    digits of its own number, so combinations are produced one after the other and never joined or held.
    """
    rows = alternatives.filter(F.col(group).isNotNull() & F.col(alt).isNotNull())
    sets = rows.groupBy(*key, group).agg(F.array_sort(F.collect_set(alt)).alias("alts"))
    whole = sets.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col(group).alias("g"), F.col("alts").alias("alts")))).alias("gs"))
    product = lambda x: F.aggregate(x, F.lit(1).cast("bigint"), lambda n, g: n * F.size(g["alts"]))
    steps = F.transform("gs", lambda g, i: F.struct(g["g"].alias("g"), g["alts"].alias("alts"), product(F.slice("gs", i + 2, F.size("gs"))).alias("step")))
    counted = whole.select(*key, steps.alias("gs"), product(F.col("gs")).alias("n"))
    each = counted.select(*key, "gs", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("combination"))
    each = each.select(*key, "combination", F.explode("gs").alias("x"))
    digit = F.expr("CAST((combination - 1) div x.step % size(x.alts) AS INT)")
    return each.select(*key, "combination", F.col("x.g").alias(group), F.col("x.alts")[digit].alias(alt))
