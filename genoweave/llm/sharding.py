"""Sharding by sampled splitters: size-weighted samples, quantile ranges, exact offsets."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import documents, range_bucket
from genoweave.session import checkpointed

SHARDS = 40
OVERHEAD = 16  # bytes that every record weighs besides its text
SNAP = 256  # groups of equal texts below 1/SNAP of a shard are never cut
PER_RANGE = 16  # sampled keys behind each splitter
ROWS_PER_RANGE = 250_000
MAX_RANGES = 4096  # bounds splitters, range totals and thereby all that the driver sees


def _lit(splitter):
    key, ident = splitter
    return F.struct(F.lit(key).alias("k"), F.lit(ident).cast("bigint").alias("i"))


def _weighted_sample(rows: DataFrame, want: float, total: int) -> list[tuple]:
    """About ``want`` keys, each row drawn with a chance in proportion to its size."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(10), "k", "i"), 11) / F.lit(float(1 << 53))
    drawn = rows.filter(u * F.lit(float(total)) < F.col("size") * F.lit(float(want)))
    return [(r["k"], r["i"]) for r in drawn.select("k", "i").collect()]


def _order(key: tuple) -> tuple:
    return (key[0], key[1] is not None, key[1] or 0)


def _choose(sample: list[tuple], n: int) -> list[tuple]:
    """n - 1 quantiles; a key's first splitter stands before the whole group, later ones cut it."""
    sample = sorted(sample, key=_order)
    chosen, seen = [], set()
    for j in range(1, n):
        k, i = sample[j * len(sample) // n] if sample else (None, None)
        if k is not None:
            chosen.append((k, i) if k in seen else (k, None))
            seen.add(k)
    return sorted(set(chosen), key=_order)


def _uncut(rows: DataFrame, splitters: list[tuple], limit: float) -> list[tuple]:
    """Drop the splitters that would cut a group of equal texts not over ``limit`` bytes."""
    cut = sorted({k for k, i in splitters if i is not None})
    if not cut:
        return splitters
    sizes = rows.filter(F.col("k").isin(cut)).groupBy("k").agg(F.sum("size").alias("b")).collect()
    small = {r["k"] for r in sizes if r["b"] <= limit}
    return [s for s in splitters if s[1] is None or s[0] not in small]


def _range_totals(rows: DataFrame, splitters: list[tuple]) -> tuple[DataFrame, dict]:
    ranged = rows.withColumn("r", range_bucket(F.struct("k", "i"), splitters, _lit))
    found = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    return ranged, {x["r"]: (x["b"], x["n"]) for x in found}


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Put every record into one of ``shards`` ranges of nearly equal bytes (law ``bytes``).

    The key is (md5 of the text, id), so equal texts are neighbours: a group of up to 1/SNAP of a
    shard is never cut, a larger one only where a boundary needs it. A size-weighted sample gives
    splitters of fine ranges; ranges that turn out overfull are subdivided by a denser sample of
    their own. Exact range totals and running sums within a range then give every record its exact
    place in key order, so the shards depend on the data alone, not on the sample. Only (key, id,
    size) is shuffled, once; splitters and range totals are bounded by ``MAX_RANGES``.

    Null texts weigh ``OVERHEAD`` bytes and group with empty ones. Null ids sort first; repeated
    rows are sharded one by one. Other columns are ignored. An empty table gives an empty result.
    Returns id, size, text_crc32, law, shard, slot, grown_shard (null under this law).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = checkpointed(
        docs.select(
            F.col(id_col).cast("bigint").alias("i"),
            F.md5(text.cast("binary")).alias("k"),
            (F.octet_length(text).cast("bigint") + OVERHEAD).alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
        )
    )
    head = rows.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    total, count = head["b"] or 0, head["n"]
    n = min(MAX_RANGES, max(shards * 8, count // ROWS_PER_RANGE))
    limit = total / shards / SNAP
    splitters = _uncut(rows, _choose(_weighted_sample(rows, n * PER_RANGE, total), n), limit) if count else []
    ranged, totals = _range_totals(rows, splitters)
    for _ in range(3):
        full = [r for r, (b, c) in totals.items() if b > 4 * total / n and c > 1]
        if not full or len(splitters) >= 2 * MAX_RANGES:
            break
        more = []
        inside = _weighted_sample(ranged.filter(F.col("r").isin(full)), 8 * n * PER_RANGE, total)
        by_range: dict[int, list] = {}
        ordered = [_order(s) for s in splitters]
        for key in inside:
            by_range.setdefault(bisect_right(ordered, _order(key)), []).append(key)
        for r, keys in by_range.items():
            more += _choose(keys, 2 + int(totals.get(r, (0, 0))[0] * n / total))
        finer = _uncut(rows, sorted({*splitters, *more}, key=_order), limit)
        if finer == splitters:
            break
        splitters = finer
        ranged, totals = _range_totals(rows, splitters)

    spark, offsets, at, rank = docs.sparkSession, [], 0, 0
    for r in sorted(totals):
        offsets.append((r, at, rank))
        at, rank = at + totals[r][0], rank + totals[r][1]
    starts = spark.createDataFrame(offsets, "r int, b0 bigint, n0 bigint")
    run = Window.partitionBy("r").orderBy("k", "i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("r", "k")
    cuts = sorted({k for k, i in splitters if i is not None})
    placed = (
        ranged.withColumn("c", F.sum("size").over(run) - F.col("size"))
        .withColumn("rn", F.row_number().over(run))
        .withColumn("g", F.sum("size").over(group))
        .withColumn("gc", F.min("c").over(group))
        .join(F.broadcast(starts), "r")
    )
    whole = (F.col("g") <= F.lit(float(limit))) & (~F.col("k").isin(cuts) if cuts else F.lit(True))
    place = F.col("b0") + F.when(whole, F.col("gc")).otherwise(F.col("c"))
    placed = placed.select(
        "i",
        "size",
        "crc",
        F.floor(place * shards / F.lit(max(total, 1))).cast("int").alias("shard"),
        (F.col("n0") + F.col("rn") - 1).alias("rank"),
    )
    placed = checkpointed(placed)
    first = placed.groupBy("shard").agg(F.min("rank").alias("rank0"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("i").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("rank0")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


# The oracle's engine has no crc32: its table is built from the polynomial, then folded over bytes.
SQL = f"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS tab),
d AS (SELECT doc_id, md5(coalesce(text, '')) AS k, CAST(strlen(coalesce(text, '')) AS BIGINT) + {OVERHEAD} AS size,
  xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
    lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS text_crc32 FROM documents, tab),
t AS (SELECT CAST(sum(size) AS BIGINT) AS total FROM d),
c AS (SELECT *, CAST(sum(size) OVER (ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS c,
  row_number() OVER (ORDER BY k, doc_id) - 1 AS rank FROM d),
g AS (SELECT *, CAST(sum(size) OVER (PARTITION BY k) AS BIGINT) AS g, min(c) OVER (PARTITION BY k) AS gc FROM c),
s AS (SELECT doc_id, size, text_crc32, rank, CAST((CASE WHEN g <= total / {SHARDS}.0 / {SNAP}.0 THEN gc ELSE c END) * {SHARDS} // total AS INTEGER) AS shard FROM g, t)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, rank - min(rank) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""
