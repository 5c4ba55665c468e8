"""Benchmark decontamination: MinHash containment search by size partition, verified exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm.common import documents, hash128
from genoweave.session import checkpointed

WORDS = 5  # words in a shingle
THRESHOLD = 0.8  # share of an item's distinct shingles that a document must hold
BROADCAST_ROWS = 400_000  # signature rows (24 bytes each) up to which they are broadcast
CHUNK = 256  # candidates of a document that are verified together


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    bare = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def _places(words: str) -> Column:
    """Starts of the shingles of an array of words: one for all if there are fewer than five."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))
    return F.when(F.size(words) > 0, starts).otherwise(F.array().cast("array<int>"))


def _hash_at(words: str, i: str) -> Column:
    return F.xxhash64(*[F.get(F.col(words), F.col(i) + j) for j in range(WORDS)])


def _shingles(words: str) -> Column:
    return F.array_distinct(F.transform(_places(words), lambda i: F.array_join(F.slice(F.col(words), i + 1, WORDS), " ")))


def signatures(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item, h): the least shingle hashes of each item, as many as its size partition asks for.

    Partition p has the items of 2^p to 2^(p+1) - 1 distinct shingles. A document that holds
    ``threshold`` of n shingles lacks at most n - ceil(threshold n), so one more of an item's
    hashes than that, least first, always has one in the document: no pair can be missed.
    """
    sizes = F.pow(F.lit(2), F.length(F.bin("n"))).cast("int") - 1  # the largest of the partition
    length = (sizes - F.ceil(sizes * F.lit(threshold) - 1e-9) + 1).cast("int")
    hashed = items.select("item", "words", F.explode(_places("words")).alias("i")).select("item", _hash_at("words", "i").alias("h"))
    grouped = hashed.groupBy("item").agg(F.array_sort(F.collect_set("h")).alias("hs")).withColumn("n", F.size("hs"))
    return grouped.select("item", F.explode(F.slice("hs", F.lit(1), length)).alias("h"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, item, n_shared, n_item, containment): documents that hold ``threshold`` of an item.

    Documents stream past the items' signatures, one hash per five-word shingle; the few candidates
    are verified by an exact intersection of shingle texts. Signatures are broadcast only if they
    are few, else hashes are shuffled to them. Texts of fewer than five words are one shingle of
    all their words, so short items match only a text of just these words; null, empty and wordless
    texts have none and never match. Documents that share an id give one row per item and n_item, with
    the largest share; items that share an id, or have none, are each searched by their own text.
    Null ids are kept on both sides; other columns are ignored; empty tables give an empty result.
    """
    # an item is its words: rows of one id, or of none, stay apart, and equal items are looked for once
    named = benchmark.select(F.col(item_col).alias("name"), words_of(F.col(item_text_col)).alias("words"))
    h1, h2 = hash128(F.array_join("words", " "))
    named = named.withColumn("item", F.struct(h1.alias("h1"), h2.alias("h2")))
    items = named.dropDuplicates(["item"]).select("item", "words")
    index = signatures(items, threshold)
    few = index.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    hashed = rows.select("id", "words", F.explode(_places("words")).alias("i")).select("id", _hash_at("words", "i").alias("h"))
    candidates = checkpointed(hashed.join(F.broadcast(index) if few else index, "h").select("id", "item").distinct())

    # a document with many candidates takes them in chunks of about CHUNK
    chunks = candidates.groupBy("id").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).withColumnRenamed("id", "of")
    dealt = candidates.join(chunks, F.col("id").eqNullSafe(F.col("of"))).withColumn("chunk", F.pmod(F.xxhash64("item"), "chunks"))
    wanted = items.select("item", _shingles("words").alias("wanted"))
    pairs = dealt.join(wanted, "item").groupBy("id", "chunk").agg(F.collect_list(F.struct("item", "wanted")).alias("items"))
    held = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text"))
    checked = (
        held.join(pairs.hint("shuffle_hash"), F.col("own").eqNullSafe(F.col("id")))
        .select("own", words_of(F.col("text")).alias("words"), "items")
        .select("own", _shingles("words").alias("has"), "items")
        .select("own", F.explode(F.transform("items", lambda x: F.struct(x["item"].alias("item"), F.size(F.array_intersect("has", x["wanted"])).alias("n_shared"), F.size(x["wanted"]).alias("n_item")))).alias("x"))
        .select("own", "x.*")
        .filter(F.col("n_shared") >= F.col("n_item") * F.lit(threshold) - 1e-9)
    )
    names = named.select("item", "name").distinct()
    best = checked.join(names, "item").groupBy("own", "name", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return best.select(
        F.col("own").alias(id_col), F.col("name").alias(item_col), "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def oracle_ctes(docs: str) -> str:
    """Common table expressions; ``leaks`` has (doc_id, item_id, n_shared, n_item)."""
    words = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
    shingles = f"list_distinct(list_transform(range(CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - {WORDS - 1}, 1) END), lambda i: array_to_string(w[i + 1:i + {WORDS}], ' ')))"
    return f"""
ds AS (SELECT doc_id, unnest({shingles}) AS s FROM (SELECT doc_id, {words} AS w FROM {docs}) x),
bs AS (SELECT item_id, s, count(*) OVER (PARTITION BY item_id) AS n_item FROM (SELECT item_id, unnest({shingles}) AS s FROM (SELECT item_id, {words} AS w FROM benchmark) x) y),
leaks AS (SELECT doc_id, item_id, count(DISTINCT s) AS n_shared, n_item FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id, n_item HAVING count(DISTINCT s) >= {THRESHOLD} * n_item - 1e-9)"""


SQL = f"""
WITH {oracle_ctes("documents")}
SELECT doc_id, item_id, CAST(n_shared AS INTEGER) AS n_shared, CAST(n_item AS INTEGER) AS n_item, n_shared / n_item AS containment FROM leaks
"""
