"""Grafted records against a plain walk over bases and pieces."""

import random

import pytest

from genoweave.operators.grafting import graft_utrs, merged_blocks, project_pieces, utr_pieces

BLOCKS = "array<struct<s:bigint,e:bigint>>"
TX = f"tx string, chrom string, forward boolean, blocks {BLOCKS}, thick_start long, thick_end long"
PROJ = f"tx string, chain long, forward boolean, blocks {BLOCKS}, thick_start long, thick_end long, q_size long, first_ok boolean, last_ok boolean"
CHAIN = "chain long, chrom string, b_start long, b_end long, q_start long, q_end long, codirected boolean"


def plain(tx, proj, chain, most, share, missing):
    _, _, forward, blocks, ts, te = tx
    _, _, q_forward, q_blocks, qs, qe, q_size, first_ok, last_ok = proj
    pieces = [(s, min(e, ts), True) for s, e in blocks if s < ts] + [(max(s, te), e, False) for s, e in blocks if e > te]
    grafts, settled = [], set()
    ok = lambda n, size: n <= most or n <= int(size * share)
    for s, e, low in pieces:
        five, adjacent, size = low == forward, (e == ts if low else s == te), e - s
        at = {}
        for _, _, b0, b1, q0, q1, co in chain:
            for x in range(max(s, b0), min(e, b1)):  # base by base
                at[x] = q0 + x - b0 if co else q1 - 1 - (x - b0)
        if at:
            co = chain[0][6]
            a, b = min(at), max(at)
            before, behind = a - s, e - 1 - b
            before, behind = (n if ok(n, size) else 0 for n in (before, behind))
            p0, p1 = (at[a] - before, at[b] + 1 + behind) if co else (at[b] - behind, at[a] + 1 + before)
            p0, p1 = max(p0, 0), min(p1, q_size)
            q_low = five == q_forward
            gap = qs - p1 if q_low else p0 - qe
            if p1 > p0 and (first_ok if five else last_ok) and ok(p1 - p0, size) and (not adjacent or ok(gap, size)):
                if adjacent:
                    p0, p1 = (p0, qs) if q_low else (qe, p1)
                if p1 > p0 and (p1 <= qs if q_low else p0 >= qe):
                    grafts.append((p0, p1))
                    if adjacent:
                        settled.add(five)
    for s, e, low in pieces:
        five = low == forward
        if missing != "leave" and (e == ts if low else s == te) and five not in settled and (first_ok if five else last_ok):
            n = e - s if missing == "deduce" else most
            p0, p1 = (max(0, qs - n), qs) if five == q_forward else (qe, min(q_size, qe + n))
            if p1 > p0:
                grafts.append((p0, p1))
    bases = sorted({x for s, e in [*q_blocks, *grafts] for x in range(s, e)})
    out = []
    for x in bases:
        if out and out[-1][1] == x:
            out[-1][1] = x + 1
        else:
            out.append([x, x + 1])
    return [tuple(b) for b in out], len(grafts)


@pytest.mark.parametrize("missing", ["leave", "deduce", "fixed"])
def test_grafts_on_both_strands(spark, missing):
    rng, txs, projs, chains, want = random.Random(5), [], [], [], {}
    for i in range(300):
        at, blocks = 50, []
        for _ in range(rng.randrange(1, 7)):
            at += rng.randrange(20, 120)
            n = rng.randrange(10, 60)
            blocks.append((at, at + n))
            at += n
        ts = rng.randrange(blocks[0][0], blocks[0][0] + 70)
        te = max(ts + 1, blocks[-1][1] - rng.randrange(0, 90))
        inside = [(max(s, ts), min(e, te)) for s, e in blocks if min(e, te) > max(s, ts)]
        if not inside:
            continue
        ts, te = inside[0][0], inside[-1][1]
        forward, co = rng.random() < 0.5, rng.random() < 0.5
        tx = (f"t{i}", "chr1", forward, blocks, ts, te)
        q_size = rng.choice([at + 40, at + 400])
        mapped = lambda s, e: (s + 7, e + 7) if co else (q_size - e - 7, q_size - s - 7)  # noqa: E731,B023
        x, chain, drift = 20, [], 0
        while x < at + 30:
            n = rng.randrange(5, 80)
            q0, q1 = mapped(x, x + n)
            drift += rng.choice([0, 0, 3, 40, 150]) * (1 if co else -1)
            if q0 + drift >= 0:
                chain.append((i, "chr1", x, x + n, q0 + drift, q1 + drift, co))
            x += n + rng.choice([0, 3, 30, 70])
        q_blocks = sorted(mapped(s, e) for s, e in inside)
        if not chain or q_blocks[0][0] < 0:
            continue
        proj = (f"t{i}", i, forward == co, q_blocks, q_blocks[0][0], q_blocks[-1][1], q_size, rng.random() < 0.8, rng.random() < 0.8)
        txs.append(tx), projs.append(proj)
        chains += chain
        want[tx[0]] = plain(tx, proj, chain, 25, 1.5, missing)
    pieces = utr_pieces(spark.createDataFrame(txs, TX))
    projections = spark.createDataFrame(projs, PROJ)
    projected = project_pieces(pieces, projections, spark.createDataFrame(chains, CHAIN), 25, 1.5)
    got = {r["tx"]: ([tuple(b) for b in r["blocks"]], r["n_grafted"]) for r in graft_utrs(projections, pieces, projected, 25, 1.5, missing).collect()}
    assert got == want
    assert sum(n for _, n in want.values()) > 60


def test_edges(spark):
    txs = [("none", "chr1", True, [(0, 50)], 10, 10), ("empty", "chr1", True, [], 0, 5), ("lost", "chr1", None, [(0, 50)], 10, 20), ("all", "chr1", True, [(0, 50)], 0, 50)]
    pieces = utr_pieces(spark.createDataFrame(txs, TX))
    assert pieces.collect() == []
    proj = spark.createDataFrame([("all", 1, True, [(5, 9), (9, 12)], 5, 12, 100, None, True)], PROJ)
    none = spark.createDataFrame([], CHAIN)
    row = graft_utrs(proj, pieces, project_pieces(pieces, proj, none), missing="deduce").first()
    assert ([tuple(b) for b in row["blocks"]], row["n_grafted"]) == ([(5, 9), (9, 12)], 0)
    joined = spark.createDataFrame([([(9, 12), (1, 3), (3, 4), (2, 3), (20, 21)],)], f"b {BLOCKS}").select(merged_blocks("b")).first()[0]
    assert [tuple(b) for b in joined] == [(1, 4), (9, 12), (20, 21)]
    with pytest.raises(ValueError):
        graft_utrs(proj, pieces, proj, missing="guess")
