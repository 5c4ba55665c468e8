"""Small column and job helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII strings take the fast built-in; others are translated."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def hash128(text: Column) -> list[Column]:
    """Two independent 64-bit hashes: the second runs over the text with another seed."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def range_bucket(key: Column, splitters: list, literal) -> Column:
    """Index of the range that holds ``key``: how many ascending splitters are <= key.

    Two levels of about sqrt(n) comparisons instead of n. ``literal`` turns a splitter into a
    column. The splitters are plan literals, so their number must be bounded by the caller.
    A null key goes to range 0.
    """
    n = len(splitters)
    if not n:
        return F.lit(0)
    step = max(1, int(n**0.5))
    parts = [splitters[i : i + step] for i in range(0, n, step)]
    # part p is the one to search if its first splitter is the last head <= key
    heads = F.array(*[literal(p[0]) for p in parts])
    above = F.size(F.filter(heads, lambda x: x <= key))
    rest = F.array(*[F.array(*[literal(x) for x in p]) for p in parts])
    found = F.when(above > 0, (above - 1) * step + F.size(F.filter(F.element_at(rest, above), lambda x: x <= key)))
    return F.coalesce(found, F.lit(0)).cast("int")
