"""Interval operators over half-open coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 1024
RANGE = 1 << 20  # bases of a sequence that one task sorts
LEVELS, FACTOR = 6, 32  # levels of bins; those of a level are this many times as long as those below
LEAST = 6  # the shortest bins that starts are looked up in have two to this power bases


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length of the overlap; zero or negative if there is none."""
    return F.least(a_end, b_end) - F.greatest(a_start, b_start)


def _binned(df: DataFrame, start: str, end: str, size: int) -> DataFrame:
    at = F.sequence(F.floor(F.col(start) / size), F.floor((F.col(end) - 1) / size))
    return df.filter(F.col(end) > F.col(start)).withColumn("_bin", F.explode(at))


def interval_join(left: DataFrame, right: DataFrame, on: list[str], l_range: tuple[str, str], r_range: tuple[str, str], size: int = BIN) -> DataFrame:
    """Pairs of rows with equal ``on`` columns and a positive overlap, each pair once.

    Both sides are exploded into bins of ``size`` and meet in an equi-join that shuffles on
    (on, bin), so a crowded sequence is spread over its bins and AQE can split a crowded bin; a pair
    that shares several bins is kept only in the bin where its overlap starts. Empty intervals match
    nothing. Column names other than ``on`` must differ between the sides.
    """
    (ls, le), (rs, re_) = l_range, r_range
    joined = _binned(left, ls, le, size).join(_binned(right, rs, re_, size), [*on, "_bin"])
    meets = (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le))
    first = F.col("_bin") == F.floor(F.greatest(ls, rs) / size)
    return joined.filter(meets & first).drop("_bin")


def _level(start: str, end: str, size: int) -> Column:
    """The lowest level whose bins are at least as long as the interval."""
    fits = [F.when(F.col(end) - F.col(start) <= size * FACTOR**k, k) for k in range(LEVELS - 1)]
    return F.coalesce(*fits, F.lit(LEVELS - 1))


def level_rows(df: DataFrame, start: str, end: str, size: int, probe: int) -> DataFrame:
    """The rows once for each bin they meet another side in: _kind, _lv, _bin.

    An interval is at home on its own level (kind 0, and again as the one that is probed), and probes
    (kind ``probe``) those above: at most two bins each, so 14 rows up to the longest bin of all.
    """
    own = df.filter(F.col(end) > F.col(start)).withColumn("_own", _level(start, end, size))
    places = [(0, F.col("_own")), (3 - probe, F.col("_own")), *[(probe, F.lit(k)) for k in range(1, LEVELS)]]
    marks = F.filter(F.array(*[F.struct(F.lit(kind).alias("k"), lv.cast("int").alias("lv")) for kind, lv in places]), lambda m: (m["k"] != probe) | (m["lv"] > F.col("_own")))
    rows = own.withColumn("_m", F.explode(marks)).withColumns({"_kind": F.col("_m.k"), "_lv": F.col("_m.lv")})
    wide = F.pow(F.lit(FACTOR), "_lv").cast("bigint") * size
    return rows.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / wide), F.floor((F.col(end) - 1) / wide)))).drop("_m", "_own")


def levelled_join(left: DataFrame, right: DataFrame, on: list[str], l_range: tuple[str, str], r_range: tuple[str, str], size: int = BIN) -> DataFrame:
    """The pairs of ``interval_join``, for intervals of any mixture of lengths.

    A pair meets on the level of the longer one: either both are at home there or the shorter one probes it, never two that
    probe. Levels on which the other side has no interval are not probed; which they are is a table of at most
    ``LEVELS`` rows, the only thing broadcast. It reads each side twice; where all intervals are
    short, ``interval_join`` does with less.
    """
    (ls, le), (rs, re_) = l_range, r_range

    def needed(rows: DataFrame, other: DataFrame, start: str, end: str, probe: int) -> DataFrame:
        there = other.filter(F.col(end) > F.col(start)).select(_level(start, end, size).cast("int").alias("_lv")).distinct().withColumn("_kind", F.lit(probe))
        kept = there.unionByName(rows.sparkSession.range(LEVELS).select(F.col("id").cast("int").alias("_lv"), F.explode(F.array(F.lit(0), F.lit(3 - probe))).alias("_kind")))
        return rows.join(F.broadcast(kept), ["_kind", "_lv"], "left_semi")

    a = needed(level_rows(left, ls, le, size, 2), right, rs, re_, 2)
    b = needed(level_rows(right, rs, re_, size, 1), left, ls, le, 1)
    joined = a.join(b, [*on, "_kind", "_lv", "_bin"])
    meets = (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le))
    first = F.col("_bin") == F.floor(F.greatest(ls, rs) / (F.pow(F.lit(FACTOR), "_lv").cast("bigint") * size))
    return joined.filter(meets & first).drop("_kind", "_lv", "_bin")


def _power(start: str, end: str) -> Column:
    """Bins of two to this power bases cut the interval into three to five pieces, short ones into fewer."""
    return F.greatest(F.floor(F.log2((F.col(end) - F.col(start)).cast("double"))).cast("int") - 1, F.lit(LEAST))


def meet_in_bins(left: DataFrame, right: DataFrame, on: list[str], l_range: tuple[str, str], start: str) -> DataFrame:
    """Left intervals and right rows that ``starts_in`` compares: those with a bin in common."""
    ls, le = l_range
    own = left.filter(F.col(le) > F.col(ls)).withColumn("_lv", _power(ls, le))
    bin_of = lambda x: F.call_function("shiftright", x.cast("bigint"), F.col("_lv"))
    a = own.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(ls)), bin_of(F.col(le) - 1))))
    b = right.crossJoin(F.broadcast(own.select("_lv").distinct())).withColumn("_bin", bin_of(F.col(start)))
    return a.join(b, [*on, "_lv", "_bin"]).drop("_lv", "_bin")


def starts_in(left: DataFrame, right: DataFrame, on: list[str], l_range: tuple[str, str], start: str) -> DataFrame:
    """Pairs of a left interval and a right row whose ``start`` lies in it (its end excluded), with equal ``on`` columns.

    A start is in one bin of each length that left intervals have, so a pair meets once, and the rows that meet in vain are
    those of the bins that an interval fills in part: about half as many as pairs. The lengths are a table of
    some sixty rows at most, the only thing broadcast. Empty intervals and nulls in ``on`` match nothing.
    """
    ls, le = l_range
    return meet_in_bins(left, right, on, l_range, start).filter((F.col(ls) <= F.col(start)) & (F.col(start) < F.col(le)))


def unit_owners(df: DataFrame, by: list[str], start: str, end: str, owner: str) -> DataFrame:
    """(by..., u_start, u_end, owner): elementary units, a row for each different owner of an interval that covers it.

    Overlapping intervals of an owner are merged first, so no unit meets an owner twice and nothing is made distinct
    behind the join; an interval finds its units by their order, however long it is.
    """
    from genoweave.operators import local  # which is built on this module

    units = discretize(df, by, start, end).select(*by, "u_start", "u_end")
    spans = df.filter(F.col(end) > F.col(start)).select(*by, owner, F.col(start).alias("_s"), F.col(end).alias("_e"))
    spans = merge_intervals(spans, [*by, owner], "_s", "_e", []).select(*by, owner, "m_start", "m_end")
    schema = f"{local.typed(units, *by)}, u_start bigint, u_end bigint, {local.typed(spans, owner)}"
    return local.local_overlaps(spans, units, by, [owner, "m_start"], ("m_start", "m_end"), ("u_start", "u_end"), local.owned(by, owner), schema)


def point_join(points: DataFrame, spans: DataFrame, on: list[str], pos: str, span: tuple[str, str], size: int = BIN) -> DataFrame:
    """Points with start <= pos <= stop, by the same bins."""
    binned = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(span[0]) / size), F.floor(F.col(span[1]) / size))))
    joined = points.withColumn("_bin", F.floor(F.col(pos) / size)).join(binned, [*on, "_bin"])
    return joined.filter((F.col(span[0]) <= F.col(pos)) & (F.col(pos) <= F.col(span[1]))).drop("_bin")


def carried(df: DataFrame, by: list[str], bins: DataFrame) -> DataFrame:
    """The rows with the columns of their own (by, _bin); ``bins`` has a row for each."""
    other = bins.select(*[F.col(c).alias(f"_own_{c}") for c in [*by, "_bin"]], *[c for c in bins.columns if c not in (*by, "_bin")])
    same = F.lit(True)
    for c in [*by, "_bin"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_own_{c}"))
    return df.join(other, same).drop(*[f"_own_{c}" for c in [*by, "_bin"]])


def merge_intervals(df: DataFrame, by: list[str], start: str, end: str, order: list[str], size: int = RANGE) -> DataFrame:
    """Islands of intervals that overlap by at least one base: by..., grp, m_start, m_end, n."""
    rows = island_rows(df, by, start, end, order, size)
    return rows.groupBy(*by, "grp").agg(F.min(start).alias("m_start"), F.max(end).alias("m_end"), F.count("*").alias("n"))


def island_rows(df: DataFrame, by: list[str], start: str, end: str, order: list[str], size: int = RANGE) -> DataFrame:
    """The intervals with the number of their island, grp.

    A sequence is cut into ranges of ``size`` by the start; a range takes over how far earlier ones
    reach and how many islands they began, so that only a row for each range is ordered in one task.
    """
    ranged = df.withColumn("_bin", F.floor(F.col(start) / size))
    earlier = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy(*by, "_bin").agg(F.max(end).alias("_max"))
    reached = carried(ranged, by, ends.select(*by, "_bin", F.max("_max").over(earlier).alias("_before")))
    w = Window.partitionBy(*by, "_bin").orderBy(start, end, *order)
    reach = F.greatest("_before", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    flagged = reached.withColumn("_new", F.when(F.col(start) < reach, 0).otherwise(1))
    begun = flagged.groupBy(*by, "_bin").agg(F.sum("_new").alias("_n"))
    begun = begun.select(*by, "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    numbered = carried(flagged, by, begun)
    # equal rows may change places between the windows: the one that begins an island stays first
    again = Window.partitionBy(*by, "_bin").orderBy(start, end, *order, F.desc("_new"))
    grp = F.col("_base") + F.sum("_new").over(again.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn("grp", grp).drop("_bin", "_before", "_new", "_base")


def discretize(df: DataFrame, by: list[str], start: str, end: str, size: int = RANGE) -> DataFrame:
    """Elementary units between neighbouring breakpoints that at least one interval covers.

    Depth is a running sum of +1 and -1 at the breakpoints, so no interval is joined to its units.
    Ranges of ``size`` take over the depth before them and the first breakpoint after them.
    """
    edges = df.filter(F.col(end) > F.col(start)).select(*by, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("d")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("d")))).alias("e"))
    steps = edges.groupBy(*by, F.col("e.at").alias("u_start")).agg(F.sum("e.d").alias("d")).withColumn("_bin", F.floor(F.col("u_start") / size))
    along = Window.partitionBy(*by).orderBy("_bin")
    bins = steps.groupBy(*by, "_bin").agg(F.sum("d").alias("_d"), F.min("u_start").alias("_first"))
    before = F.coalesce(F.sum("_d").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = carried(steps, by, bins.select(*by, "_bin", before.alias("_depth"), F.lead("_first").over(along).alias("_next")))
    w = Window.partitionBy(*by, "_bin").orderBy("u_start")
    depth = F.col("_depth") + F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    units = steps.select(*by, "u_start", F.coalesce(F.lead("u_start").over(w), "_next").alias("u_end"), depth.alias("depth"))
    return units.filter("depth > 0")


def trim_blocks(blocks: str, start: str, end: str) -> Column:
    """Blocks (array of struct s, e) clipped to [start, end); empty ones go."""
    cut = F.transform(blocks, lambda b: F.struct(F.greatest(b["s"], F.col(start)).alias("s"), F.least(b["e"], F.col(end)).alias("e")))
    return F.filter(cut, lambda b: b["e"] > b["s"])


def complement_blocks(blocks: str) -> Column:
    """Gaps between neighbouring blocks, as an array of struct (s, e): the introns."""
    n = F.size(blocks)
    pairs = F.when(n > 1, F.zip_with(F.slice(blocks, F.lit(1), n - 1), F.slice(blocks, F.lit(2), n - 1), lambda a, b: F.struct(a["e"].alias("s"), b["s"].alias("e"))))
    return F.filter(F.coalesce(pairs, F.array().cast("array<struct<s:bigint,e:bigint>>")), lambda b: b["e"] > b["s"])


def sum_lengths(blocks: Column | str) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("bigint"), lambda a, b: a + b["e"] - b["s"])


def collect_blocks(exons: DataFrame) -> DataFrame:
    """(tx, chrom, blocks) with blocks sorted by start."""
    rows = exons.groupBy("tx", "chrom").agg(F.array_sort(F.collect_list(F.struct(F.col("e_start").alias("s"), F.col("e_end").alias("e")))).alias("blocks"))
    return rows.withColumn("t_start", F.element_at("blocks", 1)["s"]).withColumn("t_end", F.array_max(F.transform("blocks", lambda b: b["e"])))
