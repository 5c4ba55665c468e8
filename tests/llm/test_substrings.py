"""Substring dedup: rows that share an id, triggers that are split over pieces, random bytes against brute force."""

import random

import numpy as np
import pytest

from genoweave.llm import substrings


def text(seed, n=300):
    r = random.Random(seed)
    return "".join(r.choice("abcdefghij klmnop") for _ in range(n))


def brute(docs):
    """docs in order of (id, text): what is left of each."""
    seen, out = {}, []
    for place, data in enumerate(docs):
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if seen.setdefault(w, (place, s)) != (place, s):
                gone[s : s + 100] = True
        out.append(np.frombuffer(data, dtype=np.uint8)[~gone].tobytes())
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def left(df):
    return [(r["doc_id"], bytes(r["kept"])) for r in df.collect()]


def test_rows_that_share_an_id_keep_their_own_bytes(spark):
    a, b, c = text(1), text(2), text(3)
    rows = [(1, a), (2, a), (2, b), (None, c), (None, b[:150]), (-(1 << 63), a[:120]), (5, c), (5, c), (None, None)]
    got = left(substrings.remove_repeats(table(spark, rows)))
    assert sorted((i, t) for i, t in got if i in (1, 2)) in (
        [(1, a[120:].encode()), (2, b""), (2, b[150:].encode())],
        [(1, a[120:].encode()), (2, b[150:].encode()), (2, b"")],
    )
    assert sorted(t for i, t in got if i is None) == sorted([c.encode(), b[:150].encode(), b""])
    assert [t for i, t in got if i == -(1 << 63)] == [a[:120].encode()]
    assert [t for i, t in got if i == 5] == [b"", b""]  # both copies repeat the null id's text


def test_repeated_rows_are_one_document(spark):
    a, b = text(4), text(5)
    got = left(substrings.remove_repeats(table(spark, [(1, a), (1, a), (2, b), (2, b), (3, a[50:250] + b[10:200])])))
    assert sorted(got) == sorted([(1, a.encode())] * 2 + [(2, b.encode())] * 2 + [(3, b"")])


@pytest.mark.parametrize("windows", [300_000, 500])
def test_shared_pieces_against_brute_force(spark, monkeypatch, windows):
    """Passages with different neighbours; small pieces split the phrases of a trigger."""
    r = random.Random(windows)
    passages = [text(100 + k, 40 + 30 * k) for k in range(12)]
    docs = []
    for i in range(150):
        parts = [text(1000 + i, r.randrange(80))]
        for _ in range(r.randrange(5)):
            p = r.choice(passages)
            at = r.randrange(len(p) // 2)
            parts += [p[at : at + r.randrange(60, 400)], text(5000 + r.randrange(50), r.randrange(1, 40))]
        docs.append("".join(parts))
    batches = substrings._sort

    def small(rows):  # runs in the Python workers, which do not see a patched module
        import genoweave.llm.substrings as s

        s.WINDOWS = windows
        return batches(rows)

    monkeypatch.setattr(substrings, "_sort", small)
    got = dict(left(substrings.remove_repeats(table(spark, list(enumerate(docs))))))
    assert [got[i] for i in range(len(docs))] == brute([d.encode() for d in docs])
