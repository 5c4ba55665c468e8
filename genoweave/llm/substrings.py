"""Exact substring dedup: a parse of the corpus into trigger phrases, and sorted suffixes of their dictionary."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import documents
from genoweave.session import checkpointed, partitions, written

LENGTH = 100  # bytes of a string whose later occurrences are removed
TRIGGER = 32  # bytes of a trigger
STEP = 1 << 20  # window starts that are hashed at once
SAMPLE_DOCS = 2000  # about so many documents tell which triggers are frequent
FREQUENT = 20  # times in that sample
SALTED = 10_000  # triggers that are dealt over many tasks, the most frequent
SIDE = LENGTH - TRIGGER - LENGTH // 3 - 1  # bytes next to a trigger: a window has so many on its left or right
TEXTS, WINDOWS = 2500, 300_000  # texts, or suffixes, that are decided together in a task
NULL_ID = -(1 << 63)  # stands for a null id, which sorts first

_TOP40 = ~np.uint64(0xFFFFFF)
_REACH = LENGTH - TRIGGER + 1  # triggers in a window
_TABLE = np.random.default_rng(7).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    if len(_powers.get(base, ())) < n:
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p, dtype=np.uint64)
    return _powers[base][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substring of some bytes, from prefix sums."""

    def __init__(self, data: bytes):
        raw = _TABLE[np.frombuffer(data, dtype=np.uint8)]
        self.n = len(raw)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(raw * _power(_BASE, max(self.n, 1))[: self.n], out=self.sums[1:])
        self.back = _power(_INVERSE, self.n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * np.uint64(_BASE))

    def triggers(self) -> np.ndarray:
        """Hash of the TRIGGER bytes from every position."""
        m = self.n - TRIGGER + 1
        return _mix((self.sums[TRIGGER:] - self.sums[:m]) * self.back[:m])


def phrases(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(trigger, phrase, lo, hi) over concatenated texts that end at ``ends``.

    The trigger of a window of LENGTH bytes is its TRIGGER bytes of the least rolling hash, the
    leftmost of equals, so it depends on the window's content alone and every window has one.
    Neighbouring windows with the same trigger, those that start at lo to hi, form a phrase: the
    bytes from lo to hi + LENGTH. Windows never cross the end of a text.

    ``trigger`` has 40 bits of the trigger's hash, then two 12-bit hashes of the trigger with the
    SIDE bytes before it and with those after it, one of which every window contains. ``phrase`` has
    48 bits of the phrase's hash, then hi - lo and the trigger's place after lo.
    """
    none = np.empty(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none.view(np.uint64), none.view(np.uint64), none, none
    h = Hashes(data)
    trigger = h.triggers()
    packed = (trigger & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(trigger), dtype=np.uint64)
    blocks = -(-len(packed) // _REACH)
    grid = np.full(blocks * _REACH, ~np.uint64(0))
    grid[: len(packed)] = packed
    grid = grid.reshape(blocks, _REACH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - LENGTH + 1
    least = np.minimum(behind[:windows], ahead[_REACH - 1 : _REACH - 1 + windows])
    own = np.repeat(ends, np.diff(ends, prepend=0))[:windows]  # the end of the text of each start
    start = np.flatnonzero(np.arange(windows) + LENGTH <= own)
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    lo, hi = start[first], start[np.concatenate((first[1:], [len(start)])) - 1]
    at = at[first]
    before = h.of(np.maximum(at - SIDE, lo), at + TRIGGER) & np.uint64(0xFFF)
    after = h.of(at, np.minimum(at + TRIGGER + SIDE, hi + LENGTH)) & np.uint64(0xFFF)
    packed = (trigger[at] & _TOP40) | (before << np.uint64(12)) | after
    shape = ((hi - lo) << 8 | (at - lo)).astype(np.uint64)
    return packed, (h.of(lo, hi + LENGTH) & ~np.uint64(0xFFFF)) | shape, lo, hi


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray]]:
    """(text numbers, their offsets, data, ends): about STEP bytes each; long texts in steps."""
    owner, skip, pieces, size = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - LENGTH + 1), STEP):
            piece = t[a : a + STEP + LENGTH - 1]
            owner.append(i)
            skip.append(a)
            pieces.append(piece)
            size += len(piece)
            if size >= STEP:
                yield owner, skip, b"".join(pieces), np.cumsum([len(p) for p in pieces])
                owner, skip, pieces, size = [], [], [], 0
    if pieces:
        yield owner, skip, b"".join(pieces), np.cumsum([len(p) for p in pieces])


def _ordered(keys: tuple[np.ndarray, ...], ident: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, later): the earliest (id, start) of every key here, and the rows after it.

    Of repeated rows, those with the id and start of the earliest, one is first and the others neither.
    """
    order = np.lexsort((lo, ident, *keys))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return _first_and_later(order, new, ident, lo)


def _first_and_later(order: np.ndarray, new: np.ndarray, ident: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_ordered``, of rows in ``order`` where ``new`` marks the head of each run of equals."""
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    si, sl = ident[order], lo[order]
    first, later = np.empty(len(order), dtype=bool), np.empty(len(order), dtype=bool)
    first[order] = new
    later[order] = (si != si[head]) | (sl != sl[head])
    return first, later


def _merged(ident: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of starts with touching ones of an id joined."""
    order = np.lexsort((lo, ident))
    ident, lo, hi = ident[order], lo[order], hi[order]
    new = np.ones(len(lo), dtype=bool)
    new[1:] = (ident[1:] != ident[:-1]) | (lo[1:] > hi[:-1] + 1)
    first = np.flatnonzero(new)
    return ident[first], lo[first], np.maximum.reduceat(hi, first) if len(first) else hi[first]


_ROWS = "known boolean, trigger bigint, key bigint, id bigint, lo int"


def _rows(open_rows: tuple[np.ndarray, ...], ident: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """Rows that are still open, (trigger, key, id, lo), then the ranges of starts known to repeat.

    Ranges that touch are joined; their key is hi - lo, and their triggers spread them evenly.
    """
    trigger, key, oid, olo = open_rows
    sid, slo, shi = _merged(ident, lo, hi)
    spread = _mix(sid.view(np.uint64) + np.arange(len(sid), dtype=np.uint64)).view(np.int64)
    known = np.concatenate((np.zeros(len(oid), dtype=bool), np.ones(len(sid), dtype=bool)))
    cols = (
        (trigger.view(np.int64), spread),
        (key.view(np.int64), shi - slo),
        (oid, sid),
        (olo.astype(np.int32), slo.astype(np.int32)),
    )
    return pa.RecordBatch.from_arrays([pa.array(known), *(pa.array(np.concatenate(c)) for c in cols)], [c.split()[0] for c in _ROWS.split(", ")])


def _decide_locally(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Of equal phrases here, (trigger, key, id, lo, hi), only the earliest is sent on; the others repeat for certain."""
    trigger, key, ident, lo, hi = (np.concatenate(x) for x in zip(*found, strict=True))
    first, later = _ordered((key, trigger & _TOP40), ident, lo)
    return _rows((trigger[first], key[first], ident[first], lo[first]), ident[later], lo[later], hi[later])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, TEXTS):
            batch = whole.slice(first, TEXTS)
            ids, found = batch["id"].to_numpy(), []
            for owner, skip, data, ends in _parts(batch["text"].to_pylist()):
                trigger, phrase, lo, hi = phrases(data, ends)
                j = np.searchsorted(ends, lo, side="right")
                shift = np.array(skip)[j] - (ends - np.diff(ends, prepend=0))[j]
                found.append((trigger, phrase, ids[np.array(owner)[j]], lo + shift, hi + shift))
            if found:
                yield _decide_locally(found)


def _lists(column: pa.Array, *fields: str) -> Iterator[tuple[np.ndarray, ...]]:
    """The fields of each row's list of structs; empty for null."""
    flat = column.flatten()
    values = [flat.field(f).to_numpy() for f in fields]
    at = 0
    for n in pc.fill_null(pc.list_value_length(column), 0).to_pylist():
        yield tuple(v[at : at + n] for v in values)
        at += n


_OPEN = "t bigint, salt int, id bigint, lo int, bytes binary"


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of every phrase that is still open: the part of the dictionary that must be sorted."""
    for batch in batches:
        _, once = np.unique(batch["id"].to_numpy(), return_index=True)  # repeated rows have the same phrases
        batch = batch.take(pa.array(np.sort(once)))
        cut: list[bytes] = []
        found: list[list[np.ndarray]] = [[], [], [], []]
        for text, ident, (lo, hi, t, salt) in zip(batch["text"], batch["id"].to_pylist(), _lists(batch["spans"], "lo", "hi", "t", "salt"), strict=True):
            data = text.as_py()
            cut += [data[a:b] for a, b in zip(lo.tolist(), (hi + LENGTH).tolist(), strict=True)]
            for column, x in zip(found, (t, salt, np.full(len(lo), ident), lo), strict=True):
                column.append(x)
        if cut:
            cols = [*(pa.array(np.concatenate(c)) for c in found), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in _OPEN.split(", ")])


def _suffixes(t: np.ndarray, ident: np.ndarray, lo: np.ndarray, phrases: pa.Array, whole: np.ndarray) -> pa.RecordBatch:
    """Sort the suffixes of some phrases by their first LENGTH bytes, then by the place in the corpus.

    In a run of equal suffixes all but the earliest repeat. Where the phrases of a trigger are not
    ``whole`` here, the earliest stays open.
    """
    size = pc.binary_length(phrases).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(phrases.to_pylist()), dtype=np.uint8)
    n = size - LENGTH + 1
    own = np.repeat(np.arange(len(n)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    suffix = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[np.repeat(np.cumsum(size) - size, n) + within]
    suffix = np.ascontiguousarray(suffix).view(f"S{LENGTH}").ravel()
    start, who = lo[own].astype(np.int64) + within, ident[own]
    place = np.lexsort((start, who))
    order = place[np.argsort(suffix[place], kind="stable")]
    ranked = suffix[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first, later = _first_and_later(order, new, who, start)
    still = np.flatnonzero(first & ~whole[own])
    key = np.array([xxhash.xxh3_64_intdigest(x) for x in suffix[still].view(np.uint8).reshape(-1, LENGTH)], dtype=np.uint64)
    return _rows((t[own[still]], key, who[still], start[still]), who[later], start[later], start[later])


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases sorted by (t, salt): whole triggers are decided here, in pieces of about WINDOWS suffixes.

    The phrases of a trigger that fill a piece alone, and those of a salted trigger, are spread over
    several pieces: their earliest suffixes stay open.
    """
    held: list[pa.RecordBatch] = []
    size, split = 0, None  # split: a trigger whose phrases have been cut

    def flush(table: pa.Table, part: int | None) -> pa.RecordBatch:
        table = table.combine_chunks()
        t = table["t"].to_numpy()
        whole = table["salt"].to_numpy() < 0
        if part is not None:
            whole &= t != part
        return _suffixes(t, table["id"].to_numpy(), table["lo"].to_numpy(), table["bytes"].combine_chunks(), whole)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            piece = batch.slice(at, 1024)
            held.append(piece)
            size += pc.sum(pc.binary_length(piece["bytes"])).as_py() - (LENGTH - 1) * piece.num_rows
            if size < WINDOWS:
                continue
            table = pa.Table.from_batches(held)
            t = table["t"].to_numpy()
            ready = int(np.searchsorted(t, t[-1]))  # the last trigger may go on
            if ready:
                yield flush(table.slice(0, ready), split)
                held = table.slice(ready).to_batches()
            else:
                split = int(t[-1])
                yield flush(table, split)
                held = []
            size = sum(pc.sum(pc.binary_length(x["bytes"])).as_py() - (LENGTH - 1) * x.num_rows for x in held)
    if held:
        yield flush(pa.Table.from_batches(held), split)


def repeated_starts(rows: DataFrame) -> DataFrame:
    """(id, lo, hi): starts of windows that also start earlier. rows: (id, text binary)."""
    spark = rows.sparkSession
    n = partitions(spark)
    parsed = rows.mapInArrow(_parse, _ROWS)
    hash40 = F.shiftright("trigger", 24)
    # frequent triggers, told from a bounded sample, are salted: it moves work, not results
    total = rows.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    sampled = rows.sample(share, seed=7).mapInArrow(_parse, _ROWS).filter("not known")
    often = [r["t"] for r in sampled.groupBy(hash40.alias("t")).count().filter(F.col("count") >= FREQUENT).orderBy(F.desc("count")).limit(SALTED).collect()]
    frequent = hash40.isin(often) if often else F.lit(False)
    salt = F.when(frequent, F.pmod(F.xxhash64("key"), F.lit(n))).otherwise(-1).cast("int")
    dealt = parsed.repartition(n, "known", hash40, salt).withColumns({"t": hash40, "salt": salt})
    # in the order of the rank below, so that one sort serves both
    group = Window.partitionBy("known", "t", "salt").orderBy("key", "id", "lo").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a trigger with one phrase has nothing else to match
    several = (F.min("key").over(group) != F.max("key").over(group)) | frequent
    own = Window.partitionBy("known", "t", "salt", "key").orderBy("id", "lo")
    # place 1 is the first; rows of rank 1 after it repeat its id and start, and say nothing new
    told = dealt.select("*", F.row_number().over(own).alias("place"), F.rank().over(own).alias("rank"), several.alias("several"))
    told = told.filter("known or rank > 1 or (place = 1 and several)")
    span = F.when(F.col("known"), F.col("key")).otherwise(F.shiftright("key", 8).bitwiseAND(0xFF))
    told = told.select(
        "id", "lo", (F.col("lo") + span).cast("int").alias("hi"), (F.col("known") | (F.col("rank") > 1)).alias("later"), "trigger", "salt", "key"
    )
    told = written(told, "phrases")

    # a window can only match another phrase that has the same bytes on one side of the trigger
    def shared(side):
        same = Window.partitionBy("t", "salt", side)
        return (F.min("key").over(same) != F.max("key").over(same)) | (F.col("salt") >= 0)

    open_spans = (
        told.filter("not later")
        .withColumn("t", hash40)
        .withColumn("at", F.col("lo") + F.col("key").bitwiseAND(0xFF).cast("int"))
        .withColumn("left", shared(F.shiftright("trigger", 12).bitwiseAND(0xFFF)))
        .withColumn("right", shared(F.col("trigger").bitwiseAND(0xFFF)))
        .withColumn("lo", F.when(F.col("left"), F.col("lo")).otherwise(F.greatest("lo", F.col("at") - SIDE + 1)))
        .withColumn("hi", F.when(F.col("right"), F.col("hi")).otherwise(F.least("hi", F.col("at") - SIDE)))
        .filter((F.col("left") | F.col("right")) & (F.col("lo") <= F.col("hi")))
        .groupBy("id")
        .agg(F.collect_list(F.struct("t", "salt", "lo", "hi")).alias("spans"))
    )
    texts = rows.join(open_spans.hint("shuffle_hash"), "id").select("id", "text", "spans")
    dictionary = texts.mapInArrow(_dictionary, _OPEN).repartition(n, "t", "salt").sortWithinPartitions("t", "salt")
    found = written(dictionary.mapInArrow(_sort, _ROWS), "suffixes")
    # what salted or very large triggers leave open meets by its hash
    earliest = Window.partitionBy("trigger", "key").orderBy("id", "lo")
    rest = found.filter("not known").withColumn("rank", F.rank().over(earliest)).filter("rank > 1")
    return (
        told.filter("later").select("id", "lo", "hi")
        .unionByName(found.filter("known").select("id", "lo", (F.col("lo") + F.col("key")).cast("int").alias("hi")))
        .unionByName(rest.select("id", "lo", F.col("lo").alias("hi")))
    )


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, own, text): own is the row's id; id orders the distinct pairs of id and text.

    Where every id has one text, as it should, the number is the id itself (a null id is the
    smallest). Else pairs are numbered in the order of the id, then of two hashes of the text.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("own"), text.alias("text"))
    usual = F.coalesce("own", F.lit(NULL_ID))
    h1, h2 = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    pair = F.struct(F.col("own").isNull().alias("none"), h1.alias("h1"), h2.alias("h2"))
    several = rows.groupBy(usual.alias("id")).agg(F.min(pair).alias("a"), F.max(pair).alias("b")).filter("a <> b")
    if several.isEmpty():
        return rows.select(usual.alias("id"), "own", "text")
    order = [F.asc_nulls_first("own"), "h1", "h2"]
    keys = rows.select("own", h1.alias("h1"), h2.alias("h2")).distinct()
    keys = keys.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    keys = checkpointed(keys.select(F.monotonically_increasing_id().alias("id"), F.col("own").alias("o"), "h1", "h2"))
    same = F.col("own").eqNullSafe(F.col("o")) & (h1 == F.col("h1")) & (h2 == F.col("h2"))
    return rows.join(keys, same).select("id", "own", "text")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, (lo, hi) in zip(batch["text"], _lists(batch["spans"], "lo", "hi"), strict=True):
            text = text.as_py()
            n = len(text)
            if len(lo):
                edge = np.zeros(n + 1, dtype=np.int32)
                np.add.at(edge, np.minimum(lo, n), 1)
                np.add.at(edge, np.minimum(hi + LENGTH, n), -1)
                gone = np.cumsum(edge)[:n] > 0
                text = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                out.append((text, n, int(gone.sum()), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))))
            else:
                out.append((text, n, 0, 0))
        cols = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", "kept", "n_bytes", "n_removed", "n_spans"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        sha = pa.array([hashlib.sha256(t).hexdigest() for t in batch["kept"].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch["id"], batch["n_bytes"], batch["n_removed"], batch["n_spans"], sha], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, kept, n_bytes, n_removed, n_spans): each text without strings of LENGTH bytes seen before.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a smaller id, or
    earlier in the same text. Strings are judged on the input. With ``digest`` the kept bytes are
    given as kept_sha256 only.

    The corpus is parsed into phrases at content-defined triggers. A phrase that isn't the first of
    its kind repeats as a whole. Where a trigger has several different phrases, they are gathered as
    a dictionary and their suffixes sorted; equal ones stand together in corpus order. What a task
    can settle alone it settles before the shuffle, so frequent passages arrive as one row a batch.

    Null and empty texts are empty; texts shorter than LENGTH stay whole. A null id is the smallest.
    Rows that share an id but not the text are documents of their own, ordered by a hash of the
    text; repeated rows count as one document and lose the same bytes. Other columns are ignored; no
    rows give no rows.
    """
    rows = numbered(docs, id_col, text_col)
    spans = repeated_starts(rows.select("id", "text")).groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = rows.join(spans.hint("shuffle_hash"), "id", "left").select(F.col("own").alias("id"), "text", "spans")
    tail = "kept_sha256 string" if digest else None
    schema = f"id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {tail}" if digest else "id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    return joined.mapInArrow(_digest if digest else _cut, schema).withColumnRenamed("id", id_col)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), digest=True)
