"""Spelling variant grouping: the full one-edit neighbourhood of every word, joined to the vocabulary by its text."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import LOWER, UPPER, documents
from genoweave.session import checkpointed

RUN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS, MIN_COUNT = 6, 5
FACTOR = 5  # a form occurs so many times as often as the word
NOISE = 199  # runs whose checksum this divides lose a code point
HELD = 500_000  # distinct words that a task counts before it passes their counts on
BITS = 27  # the filter of the vocabulary has 2^27 bits (16 MB) at any size of the input
CELLS = 1 << 21  # edits of some words that are hashed at once
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that every code point keeps its weight

_runs = re.compile(RUN).findall


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None) -> DataFrame:
    """(word, n): how often each maximal run of letters occurs, A-Z lower-cased.

    With ``noise``, a run loses a code point if ``noise`` divides the checksum of "<id>:<run>"; a
    null id counts as an empty one. Every task counts before rows are shuffled, in a bounded table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for ident, data in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found = Counter(_runs(data.lower().decode()))  # of bytes: only A-Z are lower-cased
                if noise:
                    seed = zlib.crc32(f"{ident}:".encode())
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        counts[word] += n
                else:
                    counts.update(found)
                if len(counts) > HELD:
                    yield flush()
        yield flush()

    rows = docs.filter(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, BASE))), dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[list[str]]:
    words = sorted(words, key=len)
    start = 0
    for i in range(1, len(words) + 1):
        if i == len(words) or len(words[i]) != len(words[start]):
            yield words[start:i]
            start = i


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return h & mask, (h >> np.uint64(BITS)) & mask


def vocabulary_filter(words: DataFrame) -> np.ndarray:
    """A Bloom filter of the words, 2^BITS bits packed into bytes: the same 16 MB for any vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.zeros(0, np.uint64)]
            for same in _by_length(batch["word"].to_pylist()):
                codes = _codes(same)
                bits.extend(_probes(_mixed((codes * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64))))
            at = np.concatenate(bits)
            cell = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(cell)], ["cell", "bits"])

    found = words.select("word").mapInArrow(run, "cell bigint, bits bigint").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    table[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table.view(np.uint8)


def _neighbours(words: list[str], letters: str, known: np.ndarray) -> Iterator[tuple[str, str]]:
    """(word, edit) for every deletion, replacement and insertion whose hash the filter knows.

    The hash is a polynomial in the code points, so that of each edit follows from sums over the
    code points before and after its place; no edit is spelled out before the filter has passed it.
    """
    alphabet = np.array([ord(c) for c in letters], dtype=np.uint64)
    for same in _by_length(words):
        size, width = len(same[0]), len(alphabet)
        power = _powers(size + 1)
        places = max(1, min(size + 1, CELLS // width))
        step = max(1, CELLS // (width * places))
        for first in range(0, len(same), step):
            part = same[first : first + step]
            codes = _codes(part)
            none = np.zeros((len(part), 1), np.uint64)
            before = np.concatenate((none, np.cumsum(codes * power[:size], axis=1, dtype=np.uint64)), axis=1)
            # what follows a place, moved to the left by a deletion, or to the right by an insertion
            left = np.concatenate((none, np.cumsum(codes[:, 1:] * power[: size - 1], axis=1, dtype=np.uint64)), axis=1)
            right = np.concatenate((none, np.cumsum(codes * power[1 : size + 1], axis=1, dtype=np.uint64)), axis=1)
            for at in range(0, size + 1, places):
                i = np.arange(at, min(size + 1, at + places))
                put = alphabet[None, None, :] * power[i][None, :, None]
                inserted = (before[:, i] + right[:, -1:] - right[:, i])[:, :, None] + put
                i = i[i < size]
                put = alphabet[None, None, :] * power[i][None, :, None]
                replaced = (before[:, -1:] - codes[:, i] * power[i])[:, :, None] + put
                deleted = (before[:, i] + left[:, -1:] - left[:, i])[:, :, None]
                for kind, hashes in enumerate((deleted, replaced, inserted)):
                    a, b = _probes(_mixed(hashes))
                    seven = np.uint64(7)
                    hit = (known[a >> np.uint64(3)] >> (a & seven).astype(np.uint8)) & (known[b >> np.uint64(3)] >> (b & seven).astype(np.uint8)) & 1
                    for w, p, c in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
                        word, p = part[w], p + at
                        edit = word[:p] + (letters[c] if kind else "") + word[p + (kind < 2) :]
                        if edit != word:
                            yield word, edit


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): the words of the vocabulary one inserted, deleted or replaced code point apart.

    words (word, n). All edits over the alphabet that the vocabulary itself uses are generated; those
    that a filter of fixed size proves to be no words are not shuffled, the others meet the
    vocabulary in an equi-join on their text, so no distance is computed and none is missed.
    """
    spark = words.sparkSession
    # runs hold 116 code points at most
    letters = "".join(sorted(r["c"] for r in words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect() if r["c"]))
    known = spark.sparkContext.broadcast(vocabulary_filter(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            pairs = set(_neighbours(batch["word"].to_pylist(), letters, table))
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["word", "near"])

    edits = words.select("word").mapInArrow(run, "word string, near string")
    return edits.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that begin at each word. forms (word, form), without cycles.

    Every round doubles how far a word looks ahead, so chains of k forms take about log2(k) rounds.
    """
    at = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        at = checkpointed(at.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    factor: int = FACTOR,
    noise: int | None = None,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, that
    have at least ``min_chars`` code points and occur ``min_count`` times in all texts. Near words
    are one edit apart. A word's form is its near word of largest n (the smallest in code-point order
    of equals) if that occurs ``factor`` times as often; the root is the last form.

    Null and empty texts have no words; very long runs are words like others; repeated rows count
    again; a null id only matters to ``noise``. Other columns are ignored. No rows, no words.
    """
    counted = word_counts(docs, id_col, text_col, noise)
    words = checkpointed(counted.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_chars)))
    best = Window.partitionBy("word").orderBy(F.desc("near_n"), "near")
    near = near_words(words).withColumn("r", F.row_number().over(best))
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max(F.when(F.col("r") == 1, F.struct("near", "near_n"))).alias("top"))
    found = words.join(near, "word", "left")
    takes = F.col("top.near_n") >= F.col("n") * factor
    found = checkpointed(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("top.near")).alias("form"), F.when(takes, F.col("top.near_n")).alias("form_n")))
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(documents(spark, sf_dir), noise=NOISE)


# The oracle's engine has no crc32: its table is built from the polynomial, then folded over bytes.
SQL = f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS tab),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{RUN}')) AS w FROM documents),
per AS (SELECT id, w, count(*) AS n FROM runs GROUP BY id, w),
hashed AS (SELECT w, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(id || ':' || w)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
    lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h FROM per, tab),
kept AS (SELECT CASE WHEN h % {NOISE} = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS w, n FROM hashed),
v AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY w HAVING sum(n) >= {MIN_COUNT} AND length(w) >= {MIN_CHARS}),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) AS a, substr(w, i + 1) AS b FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v) x),
pairs AS (
  SELECT x.w, y.w AS near, y.n AS near_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.w <> y.w
  UNION SELECT x.w, y.w, y.n FROM cut x JOIN v y ON x.a || x.b = y.w
  UNION SELECT y.w, x.w, x.n FROM cut x JOIN v y ON x.a || x.b = y.w),
best AS (SELECT w, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY w),
forms AS (SELECT v.w, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= {FACTOR} * v.n THEN (SELECT min(p.near) FROM pairs p WHERE p.w = v.w AND p.near_n = b.top) END AS form,
  CASE WHEN b.top >= {FACTOR} * v.n THEN b.top END AS form_n FROM v LEFT JOIN best b ON v.w = b.w),
walk AS (SELECT w, w AS at FROM forms UNION ALL SELECT walk.w, f.form FROM walk JOIN forms f ON walk.at = f.w WHERE f.form IS NOT NULL),
last AS (SELECT walk.w, walk.at FROM walk JOIN forms f ON walk.at = f.w WHERE f.form IS NULL)
SELECT f.w AS word, f.form, last.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN last ON f.w = last.w
"""
