"""Secrets and fingerprints against plain versions of their contracts."""

import hashlib
import re

import duckdb
import xxhash

from genoweave.llm import secrets, sketches
from genoweave.session import shared_path

DIR = "/root/testdata/sf0.001"
BASE = {  # pattern, group with a least length, that length
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def documents():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{DIR}/documents.parquet' ORDER BY 1").fetchall()


def test_secrets(spark):
    got = {r["doc_id"]: r for r in secrets.op8_secrets(spark, DIR).collect()}
    kinds, docs = list(BASE), documents()
    for ident, text in docs:
        found = [(m.start(), k, m.end()) for k, (p, g, n) in BASE.items() for m in re.finditer(p, text) if m.end(g) - m.start(g) >= n]
        found.sort(key=lambda s: (s[0], kinds.index(s[1])))
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in found)
        row = got[ident]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in kinds] == [sum(s[1] == k for s in found) for k in kinds]
        assert all(s in row["spans"].split(",") for s in joined.split(",") if s)
    assert len(got) == len(docs) and any(r["n_hex"] for r in got.values())


def test_later_versions_scan_only_new_blobs(spark):
    docs = spark.createDataFrame([(i, f"token = 'abcdefabcdef{i % 5}'") for i in range(40)] + [(None, "x")], "doc_id long, text string")
    path = shared_path(spark, "ledger")
    found = secrets.scan_secrets(docs, path, n_versions=4).collect()
    ledger = secrets.read_ledger(spark, path)
    assert ledger.count() == ledger.select("blob").distinct().count() == 6
    assert len(found) == 41 and sum(r["n_assign"] for r in found) == 40


M = (1 << 64) - 1


def mixed(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & M
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & M
    return h ^ (h >> 31)


def bottom(text, k=128):
    """The k least hashes of the text's distinct five-word shingles, one shingle at a time."""
    words = text.encode().lower().split()
    found = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        part = words[i : i + 5]
        h = len(part)
        for place, w in enumerate(part):
            h += xxhash.xxh64_intdigest(w) * pow(0x9E3779B97F4A7C15, place + 1, 1 << 64)
        found.add(mixed(h & M))
    return sorted(found)[:k]


def likeness(a, b, k=128):
    if not a or not b:
        return float(len(a) == len(b))
    union = sorted({*a, *b})[:k]
    return sum(x in a and x in b for x in union) / len(union)


def test_fingerprints(spark):
    got = {r["doc_id"]: r for r in sketches.op1_fingerprints(spark, DIR).collect()}
    docs = documents()
    marks = [bottom(t) for _, t in docs]
    for i, (ident, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row, own = got[ident], marks[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == "".join(f"{x:016x}" for x in own)
        assert row["edited_fingerprint"] == "".join(f"{x:016x}" for x in bottom(edited))
        assert abs(row["near_edited"] - likeness(own, bottom(edited))) < 1e-12
        assert abs(row["near_next"] - likeness(own, marks[(i + 1) % len(docs)])) < 1e-12
