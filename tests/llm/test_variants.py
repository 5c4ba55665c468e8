"""Spelling variants against a plain version that compares every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from genoweave.llm import variants as v

SCHEMA = "doc_id long, text string, word string, n long, near string, id string, form string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "n", "i", "f") for i, t in rows], SCHEMA)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, noise=None):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("noise", [None, 3])
def test_equals_all_pairs(spark, noise):
    rng = random.Random(5)
    stems = ["straße", "Élégant", "banana", "aaaaaa", "reading", "meadow"]
    texts = []
    for i in range(60):
        words = []
        for _ in range(120):
            w = list(rng.choice(stems))
            if rng.random() < 0.4:
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w[at : at + (kind < 2)] = [rng.choice("aeàÿ")] if kind else []
            words.append("".join(w))
        texts.append((None if i % 20 == 0 else i % 25, " ".join(words)))
    rows = [*texts, (7, None), (8, ""), (9, "12 34"), *texts[:3]]
    want = plain(rows, noise)
    assert got(v.group_variants(frame(spark, rows), noise=noise)) == want
    assert any(f for f, *_ in want.values()) and any(n > 4 for *_, n, _ in want.values())


def test_chains_of_forms_end_at_the_last_one(spark):
    words = [("abcdef" + "x" * i, 6**i) for i in range(5)]
    text = " ".join(" ".join([w.upper() if i % 2 else w] * (5 * n)) for i, (w, n) in enumerate(words))
    out = got(v.group_variants(frame(spark, [(1, text)])))
    assert {w: r for w, (_, r, *_) in out.items()} == dict.fromkeys([w for w, _ in words], "abcdefxxxx")
    assert out["abcdef"] == ("abcdefx", "abcdefxxxx", 5, 1, 30)


def test_ties_take_the_smallest_word_and_long_runs_are_words(spark):
    long = "ab" * 4000
    rows = [(1, " ".join(["casing"] * 5 + ["caring"] * 25 + ["cabing"] * 25)), (2, " ".join([long] * 25 + [long + "z"] * 5))]
    out = got(v.group_variants(frame(spark, rows)))
    assert out["casing"][:2] == ("cabing", "cabing") and out[long + "z"] == (long, long, 5, 1, 25)


def test_no_words(spark):
    assert v.group_variants(frame(spark, [])).collect() == []
    assert v.group_variants(frame(spark, [(1, None), (None, "a b c")])).collect() == []
