"""Every stage of the pipeline against a brute-force version on its own input."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from genoweave.llm import packing
from genoweave.session import shared_path

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """The documents, and what each stage made of them, by stage."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = {"documents": docs}
    for name, stage in p.STAGES:
        path = shared_path(spark, f"test-{name}")
        stage(spark, docs, DIR).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def test_language_keeps_clean_documents_unchanged(tables):
    before, after = texts(tables["documents"]), texts(tables["language_id"])
    assert all(before[i] == t for i, t in after.items())
    lang = {r["doc_id"]: r["lang"] for r in tables["documents"].collect()}
    clean = [i for i, t in before.items() if lang[i] and len(t.split()) >= 30]
    assert clean and np.mean([i in after for i in clean]) > 0.98
    assert not any(i in after for i, t in before.items() if not any(map(str.isalpha, t)))


def test_lines(tables):
    before, after = texts(tables["language_id"]), tables["line_dedup"].collect()
    key = lambda line: re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in before.items():
        for line in t.split("\n"):
            held[key(line)].add(i)
    gone = {k: max(ids) for k, ids in held.items() if len(k) >= 20 and len(ids) >= 3}
    assert len(after) == len(before)
    for r in after:
        want = "\n".join(x for x in before[r["doc_id"]].split("\n") if gone.get(key(x), r["doc_id"]) == r["doc_id"])
        assert (r["text"] or "") == want and (r["n_chars"] or 0) == len(want)


def five_words(text):
    words = text.encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_copies(tables):
    """Five words and a likeness of 0.8, by all pairs; of each group the smallest id stays."""
    before, after = texts(tables["line_dedup"]), texts(tables["simhash_near_dedup"])
    sets = {i: five_words(t) for i, t in before.items()}
    alike = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b) - 1e-9
    todo, want = set(sets), set()
    while todo:
        group, edge = set(), [min(todo)]
        while edge:
            a = edge.pop()
            if a in todo:
                todo.discard(a)
                group.add(a)
                edge += [b for b in todo if alike(sets[a], sets[b])]
        want.add(min(group))
    assert set(after) == want and all(before[i] == t for i, t in after.items())
    assert len(want) < len(before)


# names that the operators and stages use themselves
TAKEN = ["h", "h0", "h1", "h2", "id", "own", "own_id", "_own", "_key", "key", "row", "rid", "v", "low", "root", "bands", "body", "carried", "lost", "starts", "kept", "words", "lines", "own_h"]


@pytest.mark.parametrize("name", [n for n, _ in p.STAGES])
def test_stages_take_any_column_name(spark, tables, name):
    stage, at = dict(p.STAGES)[name], [n for n, _ in p.STAGES].index(name)
    docs = tables["documents"] if at == 0 else tables[p.STAGES[at - 1][0]]
    more = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(TAKEN)])
    got, want = stage(spark, more, DIR), tables[name]
    if name != "packing":
        assert got.columns == more.columns and got.filter(F.col("own_h") != len(TAKEN) - 1).isEmpty()
    common = sorted(set(want.columns) - {"sequence_id", "offset"})
    assert sorted(map(repr, got.select(common).collect())) == sorted(map(repr, want.select(common).collect()))


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_leaks(spark, tables):
    before, after = texts(tables["simhash_near_dedup"]), texts(tables["decontamination"])
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaked = {i for i, t in before.items() for s in [shingles(t)] if any(x and len(x & s) >= 0.8 * len(x) - 1e-9 for x in items)}
    assert set(after) == set(before) - leaked and leaked


def test_packing(tables):
    docs, pieces = texts(tables["decontamination"]), tables["packing"].collect()
    t = Tokenizer.from_file(packing.default_vocabulary())
    ids = {i: [*t.encode(x, add_special_tokens=False).ids, 2] for i, x in docs.items()}
    at, used = Counter(), defaultdict(list)
    for r in sorted(pieces, key=lambda r: r["start"]):
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == at[r["doc_id"]] and len(part) == r["length"] and zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
        at[r["doc_id"]] += r["length"]
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert at == {i: len(x) for i, x in ids.items()}
    for spans in used.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 4096
