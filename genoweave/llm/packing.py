"""Sequence packing: shortest-pack-first over the length histogram, joined back by rank."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import documents
from genoweave.session import checkpointed, partitions

MAX_TOKENS = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
MEMO_WORDS = 600_000  # words remembered by one Python worker
ENCODE_WORDS = 20_000  # words encoded in one call
ENCODE_TEXTS = 2_000  # texts whose words are looked up together


class WordEncoder:
    """Ids of whole texts through a memo of words.

    The vocabulary's pre-tokenizer never joins characters across a space or line feed, so a text's
    ids are those of its words in turn. Words that the memo lacks are encoded together and dealt
    out by their offsets.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {"": b""}

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), ENCODE_WORDS):
            part = words[i : i + ENCODE_WORDS]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.asarray(got.ids, dtype="<u4")
            ends = np.cumsum([len(w) + 1 for w in part])  # in characters, with the space
            at = np.searchsorted(np.asarray([o[0] for o in got.offsets], dtype=np.int64), ends)
            data, start = ids.tobytes(), 0
            for w, end in zip(part, at.tolist(), strict=True):
                self.memo[w] = data[4 * start : 4 * end]
                start = end

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an array of strings (null: empty), and where each text's ids begin and end."""
        plain = pc.replace_substring(texts.fill_null(""), "\n", " ")
        if not pc.any(pc.match_substring(plain, "<|")).as_py():  # else a special token may be there
            # the vocabulary lower-cases, and takes a mark after a letter and before a space alone:
            # "The, " and "the , " have the same ids, and far fewer words differ
            plain = pc.replace_substring_regex(pc.ascii_lower(plain), r"(\pL)([,.]) ", r"\1 \2 ")
        split = pc.split_pattern(plain, " ")
        coded = split.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        found = list(map(self.memo.get, words))
        new = {w for w, ids in zip(words, found, strict=True) if ids is None}
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo, new = {"": b""}, set(words)
        if new:
            self._learn(list(new))
            found = list(map(self.memo.__getitem__, words))
        size = np.array(list(map(len, found)), dtype=np.int64) // 4
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        took = size[index]
        ends = np.cumsum(took)
        shift = (np.cumsum(size) - size)[index] - (ends - took)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, took)], np.concatenate(([0], ends))[bounds]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None, limit: int) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): full pieces of ``limit`` ids, then the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary or default_vocabulary())
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for first in range(0, batch.num_rows, ENCODE_TEXTS):
                ids, bounds = encode(batch["text"].slice(first, ENCODE_TEXTS))
                for row in range(len(bounds) - 1):
                    data = ids[bounds[row] : bounds[row + 1]].tobytes() + end
                    n = len(data) // 4
                    for start in range(0, n, limit):
                        part = data[4 * start : 4 * (start + limit)]
                        for column, x in zip(out, (first + row, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                            column.append(x)
            owner = batch["id"].take(pa.array(out[0], pa.int64()))
            rest = [pa.array(c, pa.int64()) for c in out[1:]]
            yield pa.RecordBatch.from_arrays([owner, *rest], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack_histogram(counts: dict[int, int], limit: int = MAX_TOKENS) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (how many sequences, [(length, copies), ...]).

    Lengths are placed longest first, each into the packs that hold the fewest tokens so far; equal
    packs move together as one pattern with a count, so the work depends on the number of lengths
    and not on the number of pieces.
    """
    open_packs: list[tuple[int, int, int, tuple]] = []  # (tokens, tie, count, lengths)
    closed, tie = [], 0

    def put(tokens: int, count: int, lengths: tuple) -> None:
        nonlocal tie
        tie += 1
        heapq.heappush(open_packs, (tokens, tie, count, lengths))

    def grown(lengths: tuple, length: int, copies: int) -> tuple:
        return (*lengths, (length, copies))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if open_packs and open_packs[0][0] + length <= limit:
                tokens, _, count, lengths = heapq.heappop(open_packs)
                # as many copies at once as keep this pattern the shortest
                other = open_packs[0][0] if open_packs else limit
                copies = max(1, min((limit - tokens) // length, (max(other, tokens) - tokens) // length, left // count or 1))
                took = min(count, left // copies)
                if took < count:
                    put(tokens, count - took, lengths)
                put(tokens + copies * length, took, grown(lengths, length, copies))
                left -= took * copies
            else:
                copies = limit // length  # no pack has room: fill new ones, the last one in part
                full, rest = divmod(left, copies)
                if full:
                    put(copies * length, full, ((length, copies),))
                if rest:
                    put(rest * length, 1, ((length, rest),))
                left = 0
    for _, _, count, lengths in sorted(open_packs):
        merged: dict[int, int] = {}
        for length, copies in lengths:
            merged[length] = merged.get(length, 0) + copies
        closed.append((count, sorted(merged.items(), reverse=True)))
    return closed


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, copies, offset) for each pattern."""
    out, sequence, taken = [], 0, {}
    for count, lengths in patterns:
        offset = 0
        for length, copies in lengths:
            first = taken.get(length, 0)
            taken[length] = first + count * copies
            out.append((length, first, taken[length], sequence, copies, offset))
            offset += length * copies
        sequence += count
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = MAX_TOKENS) -> DataFrame:
    """Pack every document's ids (its text's, then the end id) into sequences of ``limit`` at most.

    Documents over ``limit`` ids are cut into full sequences and a rest. The driver sees only the
    histogram of piece lengths (``limit`` rows at most) and plans patterns over it. Pieces then get
    a rank among those of their length (numbered within hashed parts, plus the counts of the parts
    before, so one frequent length is never gathered), and rank picks pattern, sequence and offset.

    A null or empty text has the end id alone. Repeated rows and null ids are packed row by row;
    other columns are ignored; an empty table gives an empty result. Returns id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    found = checkpointed(pieces(docs, id_col, text_col, vocabulary, limit))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "start"), F.lit(n)).cast("int"))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = checkpointed(parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(pack_histogram(histogram, limit))
    plan = spark.createDataFrame(table, "length bigint, first bigint, last bigint, sequence bigint, copies bigint, at bigint")
    within = Window.partitionBy("length", "salt").orderBy("id", "start")
    ranked = (
        salted.withColumn("r", F.row_number().over(within) - 1)
        .join(parts.select("length", "salt", "base"), ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("r"))
    )
    here = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    # the plan's size depends on the number of lengths alone
    placed = ranked.join(F.broadcast(plan.withColumnRenamed("length", "l")), (F.col("length") == F.col("l")) & here)
    nth = F.col("rank") - F.col("first")
    return placed.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("sequence") + F.floor(nth / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + nth % F.col("copies") * F.col("length")).cast("bigint").alias("offset"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
