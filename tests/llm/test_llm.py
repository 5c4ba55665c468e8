"""Edge rows for every operator, and brute force where SQL can't express it."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from genoweave.llm import decontaminate, langid, licenses, linededup, packing, queries, secrets, sharding, simhash, sketches, substrings
from genoweave.session import shared_path

DIR = "/root/testdata/sf0.001"
LONG = "some words that repeat in every copy of this very passage, over and over, until it is long enough to be found again by any means"
ROWS = [
    (1, LONG, "en", 7), (2, LONG, "en", 7), (2, LONG, "en", 7), (3, None, None, 7), (None, "a null id, and ß letters", "de", 7),
    (4, "", "en", 7), (5, f"{LONG}\nand a tail\n{LONG}", None, 7), (6, "x " * 30000, "fr", 7), (7, "token = 'abcdefabcdefabcdef12'", "en", 7),
]
SCHEMA = "doc_id long, text string, lang string, h long"  # h clashes with internal names


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def runs(spark, docs):
    bench = spark.createDataFrame([(1, LONG), (2, None), (3, "short one")], "item_id long, text string")
    return {
        "sketch": sketches.fingerprint(docs),
        "next": sketches.with_next(docs, "doc_id", "text").mapInArrow(sketches._compare, sketches._OUT),
        "leaks": decontaminate.contaminated(docs, bench),
        "pack": packing.pack(docs),
        "simhash": simhash.near_duplicates(docs),
        "lines": linededup.drop_repeated_lines(docs),
        "lang": langid.identify(docs, langid.fit_dictionaries(docs)),
        "bytes": substrings.remove_repeats(docs),
        "secrets": secrets.scan_secrets(docs, shared_path(spark, "ledger")),
        "licenses": licenses.scan_licenses(docs),
        "shards": sharding.shard_documents(docs),
    }


def test_edge_rows(spark, rows):
    got = {k: df.collect() for k, df in runs(spark, rows).items()}
    for k, found in got.items():
        if k == "leaks":
            assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 1), (5, 1)}
        elif k != "pack":
            assert len(found) == len(ROWS), k
    assert sum(r["start"] == 0 for r in got["pack"]) == len(ROWS)
    cut = {r["doc_id"]: r["n_removed"] for r in got["bytes"]}
    assert cut[1] == 0 and cut[2] == len(LONG) and cut[5] == 2 * len(LONG)
    assert {r["doc_id"]: r["n_assign"] for r in got["secrets"]}[7] == 1
    kept = {r["doc_id"]: r["n_dropped"] for r in got["lines"]}
    assert kept[1] == 1 and kept[5] == 0
    assert {r["lang_pred"] for r in got["lang"] if r["doc_id"] in (3, 4)} == {"und"}


def test_empty_tables(spark, rows):
    for k, df in runs(spark, rows.limit(0)).items():
        assert df.count() == 0, k


def oracle(sql):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    cur = c.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, name):
    df = queries.QUERIES[name](spark, DIR)
    cols, want = oracle(queries.ORACLES[name])
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, want))


def documents():
    return oracle("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY 1")[1]


def test_substrings_brute_force(spark):
    got = {r["doc_id"]: r for r in substrings.op7_substrings(spark, DIR).collect()}
    seen = set()
    for ident, text in documents():
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                gone[s : s + 100] = True
            seen.add(w)
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        assert got[ident]["kept_sha256"] == hashlib.sha256(kept).hexdigest() and got[ident]["n_removed"] == gone.sum()


def test_simhash_brute_force(spark):
    got = {r["doc_id"]: r for r in simhash.op4_simhash(spark, DIR).collect()}
    fps = {}
    for ident, text in documents():
        w = text.encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        fps[ident] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert got[ident]["fingerprint"] == f"{fps[ident]:016x}"
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert all(got[i]["component_id"] == find(i) for i in fps)


def test_dense_near_copies_stay_one_group(spark):
    fps = spark.createDataFrame([((1 << a) | (1 << b),) for a in range(60) for b in range(a)], "fp long")
    from genoweave.operators.graph import connected_components

    assert connected_components(simhash.similar_links(fps)).select("root").distinct().count() == 1


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    got: dict = {}
    for r in packing.op3_packing(spark, DIR).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for ident, text in documents():
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(got[ident], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert r["start"] == at and zlib.crc32(part) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)


def test_packing_plan_covers_the_histogram():
    counts = {1: 1000, 5: 3, 700: 40, 2000: 7, 4096: 2}
    got: dict = {}
    for n, lengths in packing.pack_histogram(counts):
        assert sum(k * c for k, c in lengths) <= 4096
        for k, c in lengths:
            got[k] = got.get(k, 0) + n * c
    assert got == counts


def test_sketch_accuracy_and_merge(spark, rows):
    a, b = " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(600, 3600))
    x, y = sketches.sketch(a), sketches.sketch(b)
    assert abs(sketches.resemblance(x, y) - 2396 / 3596) < 0.15 and abs(sketches.containment(x, y) - 0.8) < 0.2
    df = spark.createDataFrame([(1, 0, a), (2, 0, b)], "doc_id long, g int, text string")
    merged = sketches.merge(sketches.fingerprint(df).crossJoin(df.select("g").distinct()), "g").first()["sketch"]
    assert np.array_equal(np.array(merged, dtype=np.int64).view(np.uint64), np.union1d(x, y)[: sketches.K])


def test_held_out_languages(spark):
    df = langid.op6_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = df.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95


def test_ledger_scans_only_unseen(spark, rows):
    path = shared_path(spark, "ledger")
    first = secrets.update_ledger(rows, path, kinds=["hex"]).count()
    assert secrets.update_ledger(rows, path, kinds=["hex"]).count() == first
    assert secrets.update_ledger(rows, path, kinds=["hex", "jwt"]).count() == 2 * first


def test_pipeline_keeps_columns(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns
    assert p.run(spark, DIR).count() > 0
