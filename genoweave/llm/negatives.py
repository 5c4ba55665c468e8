"""Hard negatives: exact inner-product search over vectors stored by (pivot, distance)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.session import partitions, written

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # a negative scores between LOW and HIGH percent of the positive
SCALE = 256  # components become whole 256ths
EVERY, NOISE = 100, 7  # ids of anchors, and of rows whose label moves on
PIVOTS, SAMPLE = 32, 4096  # pivots of each width, fitted on so many rows
SEGMENT, SEGMENT_BYTES = 16_384, 1 << 24  # rows and bytes of vectors that stand in one segment
WIDEN = (1, 4, None)  # half widths of the scanned intervals, in mean annuli; then what certifies
MOST = (1 << 63) - 1
EXACT = 1 << 53  # sums of products below this are exact in double precision

_ROW = "rid bigint, vec_id bigint, label bigint, dim int, vec binary, norm double"


def vector_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(rid, vec_id, label, dim, vec, norm) of the rows that take part, as a written table.

    Left out are rows with a null label, a null vector or a component that is null or not finite,
    also once it is multiplied. vec has whole doubles, norm is the sum of their squares.
    """
    x = F.col(vector_col)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < float("inf")))
    asked = rows.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), x.cast("array<double>").alias("x"), whole.alias("whole"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.floor(batch["x"].flatten().to_numpy() * SCALE)
            size = batch["x"].value_lengths().to_numpy()
            ends = np.cumsum(size)
            parts = [values[b - n : b] for b, n in zip(ends.tolist(), size.tolist(), strict=True)]
            cols = [batch["rid"], batch["vec_id"], batch["label"], pa.array(size, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([float(p @ p) for p in parts], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, ["rid", "vec_id", "label", "dim", "vec", "norm"])

    return written(asked.filter("label is not null and whole").drop("whole").mapInArrow(run, _ROW), "vectors")


def fit_pivots(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> tuple[dict[int, np.ndarray], float]:
    """Pivots of each width of vectors, and the largest norm of all.

    Every vector x gets one more component, sqrt(largest - norm), so that the nearest augmented
    vectors of (q, 0) are those of the largest inner product with q. Pivots are the means of a few
    rounds of clustering over the ``sample`` rows whose hashes are least; they steer the scan only.
    """
    most = rows.agg(F.max("norm")).first()[0] or 0.0
    taken = rows.orderBy(F.xxhash64("rid"), "rid").limit(sample).select("dim", "vec", "norm").collect()
    found = {}
    for dim in sorted({r["dim"] for r in taken}):
        x = np.array([[*np.frombuffer(r["vec"]), np.sqrt(max(0.0, most - r["norm"]))] for r in taken if r["dim"] == dim])
        means = x[:: max(1, len(x) // pivots)][:pivots].copy()
        for _ in range(6):
            near = _squares(x, means).argmin(axis=1)
            for i in np.unique(near):
                means[i] = x[near == i].mean(axis=0)
        found[dim] = means
    return found, most


def _squares(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2.0 * (x @ p.T))


def _origin(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """The pivots of a width; the origin alone for one that the sample lacks."""
    return pivots.get(dim, np.zeros((1, dim + 1)))


def index_vectors(rows: DataFrame, pivots: dict[int, np.ndarray], most: float) -> DataFrame:
    """The rows with (pivot, distance, segment), written in the order of that key.

    A segment is a run of at most ``SEGMENT`` neighbours of one pivot. Equal vectors are told apart
    by their row number, so a group of copies is spread over tasks and segments like other rows.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs, norms = batch["dim"].to_numpy(), batch["vec"].to_pylist(), batch["norm"].to_numpy()
            pivot, distance = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(vecs[i] for i in at)).reshape(len(at), dim)
                x = np.column_stack((x, np.sqrt(np.maximum(0.0, most - norms[at]))))
                d = _squares(x, _origin(pivots, dim))
                pivot[at] = d.argmin(axis=1)
                distance[at] = np.sqrt(d.min(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(distance)], [*batch.schema.names, "pivot", "distance"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, key, left = TaskContext.get().partitionId() << 32, None, 0
        for batch in batches:
            out = []
            for here in zip(batch["dim"].to_pylist(), batch["pivot"].to_pylist(), strict=True):
                if here != key or not left:
                    key, segment, left = here, segment + 1, min(SEGMENT, max(1, SEGMENT_BYTES // (8 * max(1, here[0]))))
                left -= 1
                out.append(segment)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "segment"])

    placed = rows.mapInArrow(place, f"{_ROW}, pivot int, distance double")
    order = ["dim", "pivot", "distance", "rid"]
    placed = placed.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return written(placed.mapInArrow(cut, f"{_ROW}, pivot int, distance double, segment bigint"), "vector-index")


def pivot_distances(anchors: DataFrame, pivots: dict[int, np.ndarray], most: float) -> DataFrame:
    """(anchor, dim, pivot, d): how far each augmented anchor (q, 0) lies from every pivot of its width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for rid, dim, vec in zip(*(batch[c].to_pylist() for c in ("anchor", "dim", "vec")), strict=True):
                d = np.sqrt(_squares(np.append(np.frombuffer(vec), 0.0)[None, :], _origin(pivots, dim)))[0]
                for column, values in zip(out, ([rid] * len(d), [dim] * len(d), range(len(d)), d.tolist()), strict=True):
                    column.extend(values)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["anchor", "dim", "pivot", "d"])

    return anchors.mapInArrow(run, "anchor bigint, dim int, pivot int, d double")


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; exact, and held to 64 bits."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda a: np.array([[int(v) for v in row] for row in a.tolist()], dtype=object)
    return np.clip(whole(q) @ whole(x).T, -MOST, MOST).astype(np.int64)


def _scan(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (segment, kind): a segment's vectors, then the anchors that ask for it.

    Every anchor has the same questions: rows of its own label or of others, between a least and a
    largest score. Of each, the k best rows of the segment come out. One segment and one batch of
    anchors are held at a time.
    """
    names = ("rid", "vec_id", "label", "vec")
    segment, held, ready = None, [], None
    for batch in batches:
        kinds, segments = batch["kind"].to_numpy(), batch["segment"].to_numpy()
        new = np.flatnonzero((np.diff(segments) != 0) | (np.diff(kinds) != 0)) + 1
        bounds = [0, *new.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if segments[a] != segment:
                segment, held, ready = segments[a], [], None
            if kinds[a] == 0:
                held.append([part[c].to_pylist() for c in names])
                continue
            if not held:
                continue
            if ready is None:
                rid, ident, label, vec = ([x for p in held for x in p[i]] for i in range(4))
                none = np.array([i is None for i in ident])
                ident = np.array([i or 0 for i in ident], dtype=np.int64)
                ready = np.array(rid), none, ident, np.array(label), np.frombuffer(b"".join(vec)).reshape(len(rid), -1)
            yield from _best(part, ready, k)


def _best(asks: pa.RecordBatch, ready: tuple, k: int) -> Iterator[pa.RecordBatch]:
    rid, none, ident, label, x = ready
    step = max(1, (1 << 21) // max(1, len(rid)))
    for first in range(0, asks.num_rows, step):
        part = asks.slice(first, step)
        anchor, own = part["rid"].to_numpy(), part["label"].to_numpy()
        q = np.frombuffer(b"".join(part["vec"].to_pylist())).reshape(len(anchor), -1)
        score = _scores(q, x)
        same = label[None, :] == own[:, None]
        fits = np.where(part["same"].to_numpy(zero_copy_only=False)[:, None], same & (rid[None, :] != anchor[:, None]), ~same)
        lows, highs = part["lows"].to_pylist(), part["highs"].to_pylist()
        out: list[list] = [[] for _ in range(5)]
        for i in range(len(anchor)):
            at = np.flatnonzero(fits[i])
            s = score[i, at]
            for slot, (low, high) in enumerate(zip(lows[i], highs[i], strict=True)):
                ok = (s >= low) & (s <= high)
                c, v = at[ok], s[ok]
                if len(v) > k:  # keep all that tie with the last one until ids decide
                    c, v = (y[v >= np.partition(v, len(v) - k)[len(v) - k]] for y in (c, v))
                c = c[np.lexsort((rid[c], ident[c], none[c], -v))[:k]]
                for column, values in zip(out, ([int(anchor[i])] * len(c), [slot] * len(c), score[i, c].tolist(), [None if n else y for n, y in zip(none[c].tolist(), ident[c].tolist(), strict=True)], rid[c].tolist()), strict=True):
                    column.extend(values)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["anchor", "slot", "score", "vec_id", "rid"])


def _first(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    return rows.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")


def asked_segments(turn: DataFrame, distances: DataFrame, of_pivot: DataFrame) -> DataFrame:
    """(anchor, segment): segments that may hold a row within ``wide`` of the anchor, but none within ``done``."""
    gap = lambda s: F.greatest(s["lo"] - F.col("d"), F.col("d") - s["hi"], F.lit(0.0))
    near = F.filter("segments", lambda s: (gap(s) <= F.col("wide")) & (gap(s) > F.col("done")))
    rows = turn.select("anchor", "wide", "done").join(distances, "anchor").join(of_pivot, ["dim", "pivot"])
    return rows.select("anchor", F.explode(near).alias("s")).select("anchor", "s.segment")


def search(index: DataFrame, asks: DataFrame, distances: DataFrame, most: float, k: int) -> DataFrame:
    """(anchor, slot, score, vec_id, rid): the k best rows of every slot, exactly.

    asks (anchor, dim, label, vec, norm, same, lows, highs): slot i takes scores from lows[i] to
    highs[i], of rows with the anchor's label if ``same``, else of rows with another. An anchor first
    scans the segments whose distances from their pivot are within a narrow interval of its own
    distance, then wider ones. A row that isn't scanned yet is farther from the anchor than the
    interval's half width, so once the k-th best row of every slot is no farther, the slot is
    certified. The last round scans whatever the k-th scores so far can't rule out.
    """
    n = partitions(index.sparkSession)
    bounds = written(index.groupBy("segment").agg(F.first("dim").alias("dim"), F.first("pivot").alias("pivot"), F.min("distance").alias("lo"), F.max("distance").alias("hi")), "segments")
    mean = bounds.agg(F.avg((F.col("hi") - F.col("lo")) / 2)).first()[0] or 0.0
    # a row for each pivot, with an entry for every SEGMENT rows
    of_pivot = bounds.groupBy("dim", "pivot").agg(F.collect_list(F.struct("segment", "lo", "hi")).alias("segments"))
    state = asks.withColumn("done", F.lit(-1.0))
    best = None
    vectors = index.select("segment", F.lit(0).alias("kind"), "rid", "vec_id", "label", "vec", F.lit(False).alias("same"), F.lit(None).cast("array<bigint>").alias("lows"), F.lit(None).cast("array<bigint>").alias("highs"))
    for widen in WIDEN:
        far = F.array_max(F.transform("lows", lambda low: F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + most - 2.0 * low.cast("double")))))
        needed = far * (1 + 1e-9) + 1e-6 + 1e-7 * float(np.sqrt(most))  # rounding of distances
        wide = needed if widen is None else F.least(needed, F.lit(mean * widen))
        turn = written(state.withColumns({"needed": needed, "wide": wide}).filter("done < needed"), "turn")
        if turn.isEmpty():
            break
        scanned = asked_segments(turn, distances, of_pivot).join(turn, "anchor")
        questions = scanned.select("segment", F.lit(1).alias("kind"), F.col("anchor").alias("rid"), F.lit(None).cast("bigint").alias("vec_id"), "label", "vec", "same", "lows", "highs")
        met = vectors.join(scanned.select("segment").distinct(), "segment", "left_semi")
        streamed = met.unionByName(questions).repartition(n, "segment").sortWithinPartitions("segment", "kind")
        found = streamed.mapInArrow(lambda batches: _scan(batches, k), "anchor bigint, slot int, score bigint, vec_id bigint, rid bigint")
        best = written(_first(found if best is None else best.unionByName(found), k), "best")
        # a full slot asks for nothing below its k-th score from now on
        kth = best.groupBy("anchor", "slot").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
        kth = kth.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "kth"))).alias("kth"))
        raised = F.transform("lows", lambda low, i: F.greatest(low, F.coalesce(F.element_at("kth", i), low)))
        turned = turn.select("anchor", F.col("wide").alias("now"))
        state = state.join(turned, "anchor", "left").join(kth, "anchor", "left")
        state = written(state.withColumns({"lows": raised, "done": F.coalesce("now", "done")}).drop("now", "kth"), "state")
    return best if best is not None else asks.sparkSession.createDataFrame([], "anchor bigint, slot int, score bigint, vec_id bigint, rid bigint")


def mine_hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = EVERY,
    noise: int | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides; their positives the first rows of the same
    label, and a pair's negatives the first rows of other labels that score between ``LOW`` and ``HIGH``
    percent of the positive (so none if that is negative). Scores are inner products of the vectors
    in whole ``SCALE``-ths, larger ones first, then smaller ids, null ids last. With ``noise``, the
    label of ids that it divides moves on to (label + 1) % 10.

    Rows with a null label, a null vector, or a null or infinite component take no part. Vectors of
    different widths don't meet; empty ones score 0. Equal rows are rows of their own, as anchors and
    as answers; a row without an id is never an anchor. Scores that 64 bits can't hold are cut to the
    largest that they can. Other columns are ignored. No anchors, no rows.
    """
    known = vector_rows(rows, id_col, vector_col, label_col)
    if noise:
        moved = F.when(F.col("vec_id") % noise == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        known = known.withColumn("label", moved)
    pivots, most = fit_pivots(known)
    index = index_vectors(known, pivots, most)
    anchors = known.filter(F.col("vec_id") % every == 0).select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"), "dim", "label", "vec", "norm")
    distances = written(pivot_distances(anchors.select("anchor", "dim", "vec"), pivots, most), "distances")
    one = lambda x: F.array(F.lit(x).cast("bigint"))
    near = search(index, anchors.drop("anchor_id").select("*", F.lit(True).alias("same"), one(-MOST).alias("lows"), one(MOST).alias("highs")), distances, most, positives)
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")) - 1)
    # ceil(LOW * score / HIGH) in parts, so that no product overflows
    rest = F.pmod(F.col("score"), F.lit(HIGH))
    low = ((F.col("score") - rest).cast("decimal(20,0)") / HIGH * LOW).cast("bigint") + F.ceil(rest * LOW / HIGH)
    pairs = written(ranked.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), low.alias("low")), "positives")
    slots = pairs.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "low", "positive_score"))).alias("s"))
    asks = anchors.drop("anchor_id").join(slots, "anchor").select("anchor", "dim", "label", "vec", "norm", F.lit(False).alias("same"), F.col("s.low").alias("lows"), F.col("s.positive_score").alias("highs"))
    hard = search(index, asks, distances, most, negatives)
    ranks = hard.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")))
    ranks = ranks.select("anchor", F.col("slot").alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(ranks, ["anchor", "place"]).join(anchors.select("anchor", "anchor_id"), "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), noise=NOISE)


SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % {NOISE} = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= {HIGH} * score AND {HIGH} * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= {NEGATIVES}
"""
