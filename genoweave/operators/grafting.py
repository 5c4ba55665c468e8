"""Untranslated regions: pieces of the reference, their loci in the query, and records with them grafted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.operators.intervals import interval_join

ABS_LIMIT = 3000  # bases
REL_LIMIT = 2.5  # times the piece in the reference


def _within(n: Column, size: Column, most: int, share: float) -> Column:
    """A length that exceeds at most one of the two limits."""
    return (n <= most) | (n <= F.floor(size * F.lit(share)))


def utr_pieces(transcripts: DataFrame) -> DataFrame:
    """transcripts (tx, chrom, forward, blocks, thick_start, thick_end) -> (tx, chrom, piece, five_prime, adjacent, u_start, u_end).

    What of the blocks (array of struct s, e, in order) lies outside of the thick part, numbered from 0 along
    the reference; a block that reaches into it gives the piece before or behind it, which is adjacent.
    A transcript without a thick part, without blocks or with a null strand has no pieces.
    """
    c = F.col
    left = F.filter(F.transform("blocks", lambda b: F.struct(b["s"].alias("s"), F.least(b["e"], c("thick_start")).alias("e"), F.lit(True).alias("low"))), lambda b: b["e"] > b["s"])
    right = F.filter(F.transform("blocks", lambda b: F.struct(F.greatest(b["s"], c("thick_end")).alias("s"), b["e"].alias("e"), F.lit(False).alias("low"))), lambda b: b["e"] > b["s"])
    coding = transcripts.filter("thick_end > thick_start AND forward IS NOT NULL")
    rows = coding.select("tx", "chrom", "forward", "thick_start", "thick_end", F.posexplode(F.concat(left, right)).alias("piece", "p"))
    adjacent = F.when(c("p.low"), c("p.e") == c("thick_start")).otherwise(c("p.s") == c("thick_end"))
    return rows.select("tx", "chrom", "piece", (c("p.low") == c("forward")).alias("five_prime"), adjacent.alias("adjacent"), c("p.s").alias("u_start"), c("p.e").alias("u_end"))


def project_pieces(pieces: DataFrame, pairs: DataFrame, blocks: DataFrame, most: int = ABS_LIMIT, share: float = REL_LIMIT, extrapolate: bool = True) -> DataFrame:
    """(tx, chain, piece, five_prime, adjacent, size, p_start, p_end): the pieces of the pairs (tx, chain, q_size) in the query.

    blocks (chain, chrom, b_start, b_end, q_start, q_end, codirected). An end that no block covers
    continues the nearest aligned base of the piece in a straight line, if that is no farther than ``most``
    bases or ``share`` times the piece, and within the query; else, or without ``extrapolate``, it is that base.
    A piece without an aligned base has no row. Blocks are met by chain, so a crowded locus is no hot key.
    """
    c = F.col
    wanted = pieces.join(pairs.select("tx", "chain", "q_size"), "tx")
    met = interval_join(wanted, blocks, ["chain", "chrom"], ("u_start", "u_end"), ("b_start", "b_end"), 8192)
    key = ["tx", "chain", "piece", "five_prime", "adjacent", "u_start", "u_end", "q_size"]
    block = F.struct("b_start", "b_end", "q_start", "q_end")
    rows = met.groupBy(*key).agg(F.min(block).alias("up"), F.max(block).alias("down"), F.first("codirected").alias("codirected"))
    rows = rows.withColumn("size", c("u_end") - c("u_start"))

    def reach(over: Column) -> Column:
        return F.when(over <= 0, over).when(_within(over, c("size"), most, share) & F.lit(extrapolate), over).otherwise(0)

    before, behind = reach(c("up.b_start") - c("u_start")), reach(c("u_end") - c("down.b_end"))
    low = F.when(c("codirected"), c("up.q_start") - before).otherwise(c("down.q_start") - behind)
    high = F.when(c("codirected"), c("down.q_end") + behind).otherwise(c("up.q_end") + before)
    found = rows.select("tx", "chain", "piece", "five_prime", "adjacent", "size", F.greatest(low, F.lit(0)).alias("p_start"), F.least(high, "q_size").alias("p_end"))
    return found.filter("p_end > p_start")


def merged_blocks(blocks: Column) -> Column:
    """Blocks (array of struct s, e) in order, with those that overlap or touch joined."""
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")

    def step(done: Column, b: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["s"].alias("s"), F.greatest(last["e"], b["e"]).alias("e"))
        kept = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(b["s"] <= last["e"], F.concat(kept, F.array(joined))).otherwise(F.concat(done, F.array(b)))

    plain = F.transform(blocks, lambda b: F.struct(b["s"].cast("bigint").alias("s"), b["e"].cast("bigint").alias("e")))
    return F.aggregate(F.array_sort(plain), empty, step)


def graft_utrs(projections: DataFrame, pieces: DataFrame, projected: DataFrame, most: int = ABS_LIMIT, share: float = REL_LIMIT, missing: str = "leave") -> DataFrame:
    """Every projection with the pieces it can carry: (tx, chain, r_start, r_end, thick_start, thick_end, blocks, n_grafted).

    projections (tx, chain, forward, blocks, thick_start, thick_end, q_size, first_ok, last_ok) in
    the query, one row a (tx, chain); ``first_ok`` and ``last_ok`` tell whether the terminal exons are
    there, on which the 5' and the 3' pieces depend. A piece has to lie wholly on its side of the thick part, and
    exceed ``most`` bases or ``share`` times its reference, not both. One that is adjacent in the reference is
    drawn to the thick part (or cut there), if the room between, again, exceeds one limit at most. ``missing``: what becomes of an adjacent
    piece that isn't projected or fails: ``leave``, ``deduce`` (as long as in the reference) or
    ``fixed`` (``most`` bases), at most to the end of the query. Blocks that touch or overlap are
    joined. A null flag counts as absent; a projection without pieces stays as it is.
    """
    if missing not in ("leave", "deduce", "fixed"):
        raise ValueError(f"unknown way with missing pieces: {missing}")
    c = F.col
    base = projections.select("tx", "chain", "forward", "thick_start", "thick_end", "q_size", "first_ok", "last_ok")
    here = F.coalesce(F.when(c("five_prime"), c("first_ok")).otherwise(c("last_ok")), F.lit(False))
    low = c("five_prime") == c("forward")
    rows = projected.join(base, ["tx", "chain"]).filter(here).withColumn("low", low)
    gap = F.when(c("low"), c("thick_start") - c("p_end")).otherwise(c("p_start") - c("thick_end"))
    start = F.when(c("adjacent") & ~c("low"), c("thick_end")).otherwise(c("p_start"))
    end = F.when(c("adjacent") & c("low"), c("thick_start")).otherwise(c("p_end"))
    fits = _within(c("p_end") - c("p_start"), c("size"), most, share) & (~c("adjacent") | _within(gap, c("size"), most, share))
    rows = rows.filter(fits).withColumns({"s": start, "e": end})
    rows = rows.filter((c("e") > c("s")) & F.when(c("low"), c("e") <= c("thick_start")).otherwise(c("s") >= c("thick_end")))
    grafts = rows.select("tx", "chain", "five_prime", "adjacent", "s", "e")
    if missing != "leave":
        size = c("u_end") - c("u_start") if missing == "deduce" else F.lit(most)
        due = pieces.filter("adjacent").select("tx", "five_prime", size.cast("bigint").alias("size")).join(base, "tx").filter(here)
        due = due.join(grafts.filter("adjacent"), ["tx", "chain", "five_prime"], "left_anti").withColumn("low", low)
        start = F.when(c("low"), F.greatest(c("thick_start") - c("size"), F.lit(0))).otherwise(c("thick_end"))
        end = F.when(c("low"), c("thick_start")).otherwise(F.least(c("thick_end") + c("size"), "q_size"))
        due = due.select("tx", "chain", "five_prime", F.lit(True).alias("adjacent"), start.alias("s"), end.alias("e"))
        grafts = grafts.unionByName(due.filter("e > s"))
    added = grafts.groupBy("tx", "chain").agg(F.collect_list(F.struct(c("s").cast("bigint").alias("s"), c("e").cast("bigint").alias("e"))).alias("added"))
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    own = F.transform("blocks", lambda b: F.struct(b["s"].cast("bigint").alias("s"), b["e"].cast("bigint").alias("e")))
    whole = projections.select("tx", "chain", "blocks", "thick_start", "thick_end").join(added, ["tx", "chain"], "left")
    whole = whole.withColumn("added", F.coalesce("added", none))
    whole = whole.withColumn("_all", F.when(F.size("added") > 0, merged_blocks(F.concat(own, "added"))).otherwise(own))
    return whole.select(
        "tx", "chain", F.element_at("_all", 1)["s"].alias("r_start"), F.array_max(F.transform("_all", lambda b: b["e"])).alias("r_end"),
        "thick_start", "thick_end", c("_all").alias("blocks"), F.size("added").alias("n_grafted"),
    )
