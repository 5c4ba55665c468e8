"""SimHash near-duplicates: pigeonring candidate chains, then components of the verified links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm.common import documents
from genoweave.operators.graph import connected_components
from genoweave.session import checkpointed, partitions

WORDS = 4  # words in a shingle
BUDGET = 4  # differing bits that still link
SEED = 42
WIDTHS = (13, 13, 13, 13, 12)  # segments of the ring, from the lowest bits
CHUNK = 1024  # fingerprints of a key that one task compares with another chunk


def fingerprint(data: bytes) -> int:
    """64-bit SimHash of UTF-8 text: a bit is set if it is set in over half the shingle hashes."""
    words = data.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), len(words) - WORDS + 1
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip([0, *ends[: n - 1]], [e - 1 for e in ends[WORDS - 1 :]], strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(bits), 65536):
        counts += bits[i : i + 65536].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the signed 64-bit value of every whole text's fingerprint; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t or b"") for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(fps.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


_AT = [sum(WIDTHS[:i]) for i in range(len(WIDTHS))]
_SEG = [((1 << w) - 1) << a for w, a in zip(WIDTHS, _AT, strict=True)]
#: _CHAIN[i][l - 1]: the bits of the l consecutive segments that start with segment i
_CHAIN = np.array([[sum(_SEG[(i + j) % 5] for j in range(n)) for n in range(1, 6)] for i in range(5)], dtype=np.uint64)
#: differences that a chain of l segments may hold: its share of the budget
_ALLOWED = [n * BUDGET // len(WIDTHS) for n in range(1, 6)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ring_keys(fp) -> list:
    """Ten keys of a fingerprint; pairs within the budget share one at least.

    By the pigeonring principle some segment i begins a chain whose every prefix of l segments has
    at most l * budget / 5 differences: none in segment i, so at most one in segment i + 1, which
    leaves one of that segment's halves equal. A key is (i, which half, those bits).
    """
    keys = []
    for i in range(5):
        j = (i + 1) % 5
        low = ((1 << WIDTHS[j] // 2) - 1) << _AT[j]
        for half, mask in enumerate((low, _SEG[j] & ~low)):
            bits = fp.bitwiseAND(F.lit(_signed(_SEG[i] | mask)))
            keys.append(F.struct(F.lit(i * 2 + half).alias("i"), bits.alias("bits")))
    return keys


def _settle(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the trees of u and v in ``label``, where every node ends at its least node."""
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not (label[label] == label).all():
            label[:] = label[label]


def _links(start: np.ndarray, group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links of the components that the verified pairs inside groups form.

    Rows are sorted by group. Pairs are tried at growing distance; pairs already connected are
    skipped, so a dense group costs comparisons but never a list of all its links.
    """
    nodes, node = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    rows = np.arange(len(fp))
    d = 1
    while True:
        rows = rows[rows + d < len(fp)]
        rows = rows[group[rows] == group[rows + d]]
        if not len(rows):
            break
        here = rows[label[node[rows]] != label[node[rows + d]]]
        x, chain = fp[here] ^ fp[here + d], _CHAIN[start[here]]
        for n in range(2, 6):  # pruned chain by chain; the last one is the full Hamming check
            ok = np.bitwise_count(x & chain[:, n - 1]) <= _ALLOWED[n - 1]
            here, x, chain = here[ok], x[ok], chain[ok]
        if len(here):
            _settle(label, node[here], node[here + d])
        d += 1
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (i, bits, part): links of each group, the last group kept for the next batch."""
    rest = None
    names = ("i", "bits", "part")

    def emit(cols: list[np.ndarray]) -> pa.RecordBatch:
        new = np.zeros(len(cols[0]), dtype=bool)
        for c in cols[:3]:
            new[1:] |= c[1:] != c[:-1]
        a, b = _links(cols[0] // 2, np.cumsum(new), cols[3])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        cols = [batch[n].to_numpy() for n in names] + [batch["fp"].to_numpy().view(np.uint64)]
        if rest is not None:
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
        last = np.ones(len(cols[0]), dtype=bool)
        for c in cols[:3]:
            last &= c == c[-1]
        cut = len(last) - int(last.sum())
        rest = [c[cut:] for c in cols]
        if cut:
            yield emit([c[:cut] for c in cols])
    if rest is not None and len(rest[0]):
        yield emit(rest)


def similar_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the budget, not all pairs.

    A key with over ``CHUNK`` fingerprints is cut into chunks, and every two chunks meet in a group
    of their own, so no task gathers a frequent key.
    """
    n = partitions(fps.sparkSession)
    keyed = fps.select("fp", F.explode(F.array(*ring_keys(F.col("fp")))).alias("k")).select("fp", "k.i", "k.bits")
    heavy = keyed.groupBy("i", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK)
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    part = F.transform(F.sequence(F.lit(0), chunks - 1), lambda j: F.least(own, j) * chunks + F.greatest(own, j))
    split = keyed.join(heavy, ["i", "bits"], "left").select(
        "i", "bits", "fp", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(part)).alias("part")
    )
    grouped = split.repartition(n, "i", "bits", "part").sortWithinPartitions("i", "bits", "part")
    return grouped.mapInArrow(_verify, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): documents linked through fingerprints at most 4 bits apart.

    Equal fingerprints are one vertex, so copies are never paired. component_id is the smallest id
    reachable. Null, empty and wordless texts have fingerprint zero and link like any other; texts
    of fewer than four words are one shingle. Repeated rows get a row each; a null id counts only
    where a component has no other. Other columns are ignored; no rows give no rows.
    """
    marked = checkpointed(fingerprints(docs, id_col, text_col))
    fps = checkpointed(marked.groupBy("fp").agg(F.min("id").alias("low")))
    root = connected_components(similar_links(fps.select("fp")))
    rooted = fps.join(root, fps["fp"] == root["vertex"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_fp = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
