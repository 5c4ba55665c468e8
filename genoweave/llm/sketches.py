"""Document fingerprints: bottom-k sketches of shingle hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import documents, range_bucket
from genoweave.session import partitions

WORDS = 5  # words in a shingle
K = 128  # hashes kept
MEMO_WORDS = 400_000  # word hashes remembered by one Python worker
RANGES = 4  # id ranges for each partition, so that hashed ranges even out
MAX_RANGES = 4096

# Odd multipliers, one for each place in a shingle: powers of one odd constant.
_PLACE = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(WORDS)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(data: bytes) -> np.ndarray:
    """A hash for every five-word shingle of UTF-8 text, in order, repeats included; empty without words.

    Words are split at ASCII white space, A-Z lower-cased. Fewer words are one shingle.
    """
    words = data.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.array([_hashes[w] for w in words], dtype=np.uint64)
    n = max(1, len(h) - WORDS + 1)
    total = np.full(n, len(words) if len(words) < WORDS else WORDS, dtype=np.uint64)
    for i in range(min(WORDS, len(h))):
        total += h[i : i + n] * _PLACE[i]
    return _mix(total)


def sketch(text: str, k: int = K) -> np.ndarray:
    """The k least distinct hashes of the text's shingles, ascending; empty without words."""
    found = shingle_hashes(text.encode())
    if len(found) > 8 * k:  # repeats may need more than the first k; then all are sorted
        low = np.unique(np.partition(found, 4 * k)[: 4 * k])
        if len(low) >= k:
            return low[:k]
    return np.unique(found)[:k]


def distinct_shingles(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(s)) if len(s) < k else (k - 1) / (float(s[k - 1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: the share of the union's k least hashes that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:k]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_shingles(np.union1d(a, b)[:k], k)
    return min(1.0, both / distinct_shingles(a, k))


def to_text(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(id, sketch): the bottom-k hashes as a sorted array of unsigned values in signed longs; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(t or "", k).view(np.int64) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found, pa.list_(pa.int64()))], ["id", "sketch"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, sketch array<bigint>")
    return out.withColumnRenamed("id", id_col)


def merge(sketched: DataFrame, key_col: str, k: int = K) -> DataFrame:
    """(key, sketch) of the union of each key's documents, from their sketches alone.

    The k least distinct hashes of a union are among the parts' own. Ranks are cut before the
    shuffle, so a key with most of the documents sends k rows a task.
    """
    unsigned = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))  # orders signed longs as unsigned
    rows = sketched.select(F.col(key_col).alias("key"), F.explode("sketch").alias("h")).withColumn("u", unsigned)
    least = rows.withColumn("r", F.dense_rank().over(Window.partitionBy("key").orderBy("u"))).filter(F.col("r") <= k)
    out = least.select("key", "u", "h").distinct().groupBy("key").agg(F.array_sort(F.collect_list(F.struct("u", "h"))).alias("s"))
    return out.select(F.col("key").alias(key_col), F.transform("s", lambda x: x["h"]).alias("sketch"))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(r, peek, id, text): rows dealt into id ranges, each range followed by a peek at the next row.

    Ranges begin at ids that occur, so the row after a range's last is the one whose id begins the
    next range; that one is sent to both. The row after the last is the first of all.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    n = min(MAX_RANGES, RANGES * partitions(spark))
    seen = rows.agg(
        F.min("id").alias("low"),
        F.count_if(F.col("id").isNull()).alias("nulls"),
        F.percentile_approx("id", [i / n for i in range(1, n)], 4 * n).alias("q"),
    ).first()
    cuts = sorted({c for c in seen["q"] or [] if c > seen["low"]})
    first = None if seen["nulls"] else seen["low"]
    r = range_bucket(F.col("id"), cuts, F.lit)
    peek = F.when(F.col("id").eqNullSafe(F.lit(first).cast("bigint")), F.lit(len(cuts)))
    if cuts:
        peek = peek.when(F.col("id").isin(cuts), r - 1)
    places = F.array_compact(F.array(F.struct(r.alias("r"), F.lit(0).alias("peek")), F.when(peek.isNotNull(), F.struct(peek.alias("r"), F.lit(1).alias("peek")))))
    dealt = rows.select("id", "text", F.explode(places).alias("p")).select("p.r", "p.peek", "id", "text")
    return dealt.repartition(partitions(spark), "r").sortWithinPartitions("r", "peek", F.asc_nulls_first("id"), "text")


_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double, in_edited double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row after it in its range."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
    held = None  # (range, id, text, sketch) that waits for its next row

    def flush(out: list) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for batch in batches:
        out = []
        for r, peek, ident, text in zip(*(batch[c].to_pylist() for c in ("r", "peek", "id", "text")), strict=True):
            if peek and held is None:
                continue  # a repeated row of the same id
            text = text or ""
            own = sketch(text)
            if held is not None:
                _, last, before, s = held
                n = len(before)
                cut = n // 4
                edited = before[: n - cut] + text[:cut]
                e = sketch(edited) if cut else s
                out.append((last, n, hashlib.sha256(edited.encode()).hexdigest(), to_text(s), to_text(e), resemblance(s, e), resemblance(s, own), distinct_shingles(s), containment(s, e)))
            held = None if peek else (r, ident, text, own)
            if len(out) >= 1000:
                yield flush(out)
                out = []
        yield flush(out)
    if held is not None:
        raise RuntimeError("a range ended without the row after it")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(documents(spark, sf_dir), "doc_id", "text").mapInArrow(_compare, _OUT)
