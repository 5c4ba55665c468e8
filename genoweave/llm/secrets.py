"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm.common import documents, range_bucket
from genoweave.session import checkpointed, shared_path

_ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# Fixed values. kind: (version, pattern, group that must have a least length, that length, needles).
# A text without any needle (looked for in lower case) cannot match. The first three kinds are the
# base kinds, in their stated order; the others are formats that issuers of keys have published.
RULES = {
    "assign": (1, re.compile(_ASSIGN, re.I), 2, 12, (b"passw", b"secret", b"token", b"apikey", b"api_key")),
    "access": (1, re.compile(rb"AKIA[A-Z0-9]+"), 0, 18, (b"akia",)),
    "hex": (1, re.compile(rb"[0-9a-f]{16,}"), 0, 16, ()),
    "private_key": (1, re.compile(rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1, (b"private key-----",)),
    "jwt": (1, re.compile(rb"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1, (b"eyj",)),
    "forge_token": (1, re.compile(rb"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1, (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_")),
    "chat_token": (1, re.compile(rb"xox[abprs]-[A-Za-z0-9-]{10,}"), 0, 1, (b"xox",)),
    "url_login": (1, re.compile(rb"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/@]{3,64}@"), 0, 1, (b"://",)),
}
BASE = ("assign", "access", "hex")

SPAN = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob binary, rules array<string>, spans {SPAN}"
VERSIONS = 2  # versions of the corpus that the query adds to the ledger, one after the other


def scan_text(data: bytes, kinds: list[str]) -> dict[str, list[tuple[str, int, int]]]:
    """Spans of each kind in code points, end exclusive: leftmost, non-overlapping per kind."""
    lower, plain, out = data.lower(), data.isascii(), {}
    for kind in kinds:
        _, pattern, group, least, needles = RULES[kind]
        found = out[kind] = []
        byte = point = 0  # an offset in bytes and the same in code points, moved from match to match
        if needles and not any(n in lower for n in needles):
            continue
        for m in pattern.finditer(data):
            if m.end(group) - m.start(group) >= least:
                first, last = m.span()
                if not plain:
                    first = point + len(data[byte:first].decode())
                    byte, last = last, first + len(m.group().decode())
                    point = last
                found.append((kind, first, last))
    return out


def _rule(kind: str) -> str:
    return f"{kind}@{RULES[kind][0]}"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("blob", pa.binary()), ("rules", pa.list_(pa.string())), ("spans", pa.list_(span))])
    for batch in batches:
        rows = []
        for blob, text, rules in zip(batch["blob"], batch["text"], batch["todo"].to_pylist(), strict=True):
            found = scan_text(text.as_py(), [r.split("@")[0] for r in rules])
            spans = [dict(zip(("kind", "start", "end"), s, strict=True)) for kind in found.values() for s in kind]
            rows.append({"blob": blob.as_py(), "rules": rules, "spans": spans})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger table: for each scan of a blob the rules ("kind@version") and what they found; may be new."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def update_ledger(docs: DataFrame, ledger: str, text_col: str = "text", kinds: list[str] | None = None) -> DataFrame:
    """Scan the blobs of ``docs`` for the (blob, rule version) pairs that the ledger lacks.

    Equal texts are one blob (SHA-256 of the UTF-8 bytes; null counts as empty), scanned once
    however many documents or versions hold it. A row for each blob that had something unseen is
    appended to the ledger, a Parquet table at ``ledger``, and the whole ledger is returned.
    """
    spark, kinds = docs.sparkSession, kinds or list(RULES)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    blobs = docs.select(F.unhex(F.sha2(data, 256)).alias("blob"), data.alias("text")).dropDuplicates(["blob"])
    have = read_ledger(spark, ledger)
    wanted = F.array(*[F.lit(_rule(k)) for k in kinds])
    if have.isEmpty():
        unseen = blobs.withColumn("todo", wanted)
    else:
        known = have.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
        todo = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
        unseen = blobs.join(known, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0).drop("known")
    unseen.mapInArrow(_scan, LEDGER).write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger)


def versions(docs: DataFrame, id_col: str, n: int) -> list[DataFrame]:
    """The rows that each of ``n`` versions of the corpus adds: ranges of ascending ids; every row is in one."""
    cuts = docs.agg(F.percentile_approx(F.col(id_col), [i / n for i in range(1, n)], 10000).alias("q")).first()["q"] or []
    added = range_bucket(F.col(id_col), sorted(set(cuts)), F.lit)
    return [docs.filter(added == i) for i in range(len(set(cuts)) + 1)]


def scan_secrets(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", n_versions: int = 1) -> DataFrame:
    """Findings of every document, through the ledger.

    The corpus is added in ``n_versions`` versions, oldest first; of each only blobs that no earlier
    one held are scanned, and findings are joined back to the documents of all versions. Returns
    id, n_assign, n_access, n_hex, base_sha256 and spans (all spans as kind:start:end, by start, then
    kind as listed in ``RULES``). Null and empty texts have no spans; repeated rows get a row each;
    null ids are kept and are of the first version; other columns are ignored; an empty table gives none.
    """
    for added in versions(docs, id_col, n_versions) if n_versions > 1 else [docs]:
        scanned = update_ledger(added, ledger, text_col)
    current = F.create_map(*[F.lit(x) for k in RULES for x in (k, _rule(k))])
    order = F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*[F.lit(i) for i in range(len(RULES))]))
    # findings of the current rule versions: one small row for each blob that has any
    valid = F.filter("spans", lambda s: F.array_contains(F.col("rules"), F.try_element_at(current, s["kind"])))
    found = (
        scanned.select("blob", valid.alias("spans")).filter(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind"))))))).alias("s"))
    )
    found = checkpointed(found)  # small; so that a blob of many documents can be split in the join
    blob = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    spans = F.coalesce("s", F.array().cast("array<struct<start:int,o:int,end:int,kind:string>>"))
    join = lambda keep: F.array_join(F.transform(F.filter(spans, keep), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return (
        docs.select(F.col(id_col), blob.alias("blob"))
        .join(found, "blob", "left")
        .select(
            id_col,
            *map(count, BASE),
            F.sha2(join(lambda s: s["kind"].isin(*BASE)).cast("binary"), 256).alias("base_sha256"),
            join(lambda s: F.lit(True)).alias("spans"),
        )
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir), shared_path(spark, "secret-ledger"), n_versions=VERSIONS)
