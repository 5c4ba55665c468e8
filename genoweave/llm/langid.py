"""Language identification by compression with one raw-content dictionary per language."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import documents

SAMPLE_DOCS = 512  # most documents read for one language's dictionary
EXCERPT = 512  # most bytes that one of them gives, so that a wrong label weighs little
BLOCK = 2048  # a text is encoded in blocks of so many bytes, each against the dictionary alone
LEVEL = 3
ENDINGS = 32  # endings of each block that are encoded too if a text's margin is narrow
MARGIN = 0.004  # reject if the second smallest size isn't at least this much above the smallest
SHARPNESS = 60.0  # of the score: how fast a relative margin becomes certainty


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The whole text in lower case, every run of other characters than letters as one space."""
    return _OTHER.sub(" ", text.lower()).encode()


def fit_dictionaries(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", languages: int | None = None) -> dict[str, bytes]:
    """One dictionary of raw text per language, most frequent language first.

    The fit reads a bounded sample: for each language the distinct texts of the lowest hashes,
    ``SAMPLE_DOCS`` at most, ``EXCERPT`` bytes of each. Copies of a text count once, however many
    there are. All languages are learned, or the ``languages`` most frequent. Rows with a null
    language or without text are left out.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text <> ''")
    rows = rows.withColumn("h", F.xxhash64("text"))
    each = rows.groupBy("lang", "h").agg(F.count("*").alias("n"))
    counts = each.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("d")).orderBy(F.desc("n"), "lang")
    counts = (counts if languages is None else counts.limit(languages)).collect()
    u = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    excerpt = F.substring("text", 1, 2 * EXCERPT).alias("text")  # longer, as letters() shortens it

    def lowest(shares: dict[str, float]) -> dict[str, list[tuple[int, str]]]:
        """The texts of lowest hash among those whose hash is under the language's share."""
        share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        few = rows.filter(u < F.try_element_at(share, F.col("lang"))).select("lang", "h", excerpt)
        low = (
            few.groupBy("lang", "h")
            .agg(F.min("text").alias("text"))
            .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(u)))
            .filter(F.col("r") <= SAMPLE_DOCS)
        )
        texts: dict[str, list[tuple[int, str]]] = {k: [] for k in shares}
        for r in low.select("lang", "h", "text").collect():
            texts[r["lang"]].append((r["h"], r["text"]))
        return texts

    # a hash threshold for each language leaves about 8 * SAMPLE_DOCS distinct texts of it, wherever they lie
    texts = lowest({r["lang"]: 8.0 * SAMPLE_DOCS / r["d"] for r in counts}) if counts else {}
    scarce = {r["lang"]: 1.0 for r in counts if len(texts[r["lang"]]) < min(SAMPLE_DOCS, r["d"])}
    texts |= lowest(scarce) if scarce else {}
    return {r["lang"]: b" ".join(letters(t)[:EXCERPT] for _, t in sorted(texts[r["lang"]])) for r in counts}


def endings(block: bytes) -> list[bytes]:
    """The block from its first word on, and from others spread evenly; from every word if they are few."""
    words = block.split()
    step = -(-len(words) // ENDINGS)
    return [b" ".join(words[i:]) for i in range(0, len(words), max(1, step))]


class Classifier:
    """Sizes of a text under each language's dictionary; smallest wins, ties go to the more frequent."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = list(dictionaries)
        self.packers = []
        for content in dictionaries.values():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected)."""
        if not self.packers or not text or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0, True
        data = letters(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(p.compress(b)) for b in blocks) for p in self.packers]
        least = min(sizes)
        if sorted(sizes)[:2][-1] - least < MARGIN * least:
            # whole bytes are too coarse here: sum the sizes of endings that start at a word
            ends = [e for b in blocks for e in endings(b)]
            sizes = [sum(len(p.compress(e)) for e in ends) for p in self.packers]
            least = min(sizes)
        over = [(s - least) / least for s in sizes]
        second = sorted(over)[1] if len(over) > 1 else math.inf
        score = 1 / sum(math.exp(-SHARPNESS * x) for x in over)
        return self.langs[sizes.index(least)], score, second, second < MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (0 to 1), margin and rejected for every whole text; no shuffle.

    A null text or one without a letter, or any text if nothing was learned, is ``und`` and
    rejected. Repeated rows and null ids get a row each; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch["text"]]
            cols = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, margin double, rejected boolean")
    return found.withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose own text is not rejected, all columns kept; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in batches:
            yield batch.filter(pa.array([not classify(t.as_py())[3] for t in batch[text_col]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = fit_dictionaries(docs.filter(~held_out()))
    return identify(docs, known).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")
