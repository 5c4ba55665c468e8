"""Overlaps folded where they meet: equal to all pairs by brute force, and no pair is shuffled."""

import random

from genoweave.operators import annotation as A
from genoweave.operators import chains as C


def _tables(spark, seed=5):
    rnd = random.Random(seed)
    exons, blocks = [], []
    for tx in range(60):
        at, long = rnd.randrange(-3000, 60000), tx % 20 == 0  # a few transcripts are on a higher level
        for exon in range(rnd.randrange(1, 6)):
            at += rnd.randrange(0, 90000 if long else 900)
            exons.append((f"t{tx}", "a" if tx % 3 else "b", None if rnd.random() < 0.05 else exon, at, at + rnd.randrange(0, 200)))
    for chain in range(25):
        at = rnd.randrange(-3000, 50000)
        for blk in range(rnd.randrange(1, 40)):
            size = 5000 if rnd.random() < 0.02 else rnd.randrange(0, 120)
            blocks.append((chain, "a" if chain % 3 else "b", blk, at, at + size))
            at += size + rnd.randrange(-20, 700)
    blocks.append((99, None, 0, 0, 1000))
    e = spark.createDataFrame(exons, "tx string, chrom string, exon bigint, e_start bigint, e_end bigint")
    b = spark.createDataFrame(blocks, "chain bigint, chrom string, blk bigint, b_start bigint, b_end bigint")
    return exons, blocks, e, b


def _met(exons, blocks):
    for tx, chrom, exon, s, e in exons:
        for chain, other, _, bs, be in blocks:
            if chrom == other and e > s and be > bs and s < be and bs < e:
                yield tx, chain, exon, max(s, bs), min(e, be)


def test_coverage(spark):
    exons, blocks, e, b = _tables(spark)
    want = {}
    for tx, chain, exon, lo, hi in _met(exons, blocks):
        seen = want.setdefault((tx, chain), [set(), 0])
        seen[0] |= {exon} - {None}
        seen[1] += hi - lo
    found = C.block_exon_coverage(e, b)
    assert {(r.tx, r.chain): (r.n_exons, r.cov) for r in found.collect()} == {k: (len(x), n) for k, (x, n) in want.items()}
    assert len(want) == found.count()


def test_only_inputs_are_shuffled(spark):
    """Before, the pairs were shuffled by transcript and chain; now nothing follows the step that makes them."""
    _, _, e, b = _tables(spark)
    plan = C.block_exon_coverage(e, b)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Exchange" not in plan.split("MapInArrow")[0]


def test_flanks(spark):
    exons, blocks, e, b = _tables(spark, 6)
    spans = {}
    for tx, chrom, _, s, end in exons:
        low, high = spans.get((tx, chrom), (s, end))
        spans[tx, chrom] = min(low, s), max(high, end)
    sums = lambda tracks: {(t, c): sum(hi - lo for x, y, _, lo, hi in _met(tracks, blocks) if (x, y) == (t, c)) for t, c, *_ in set((x, y) for x, y, *_ in _met(tracks, blocks))}
    wide = sums([(tx, chrom, 0, max(1, s - 3000), end + 3000) for (tx, chrom), (s, end) in spans.items()])
    body = sums([(tx, chrom, 0, s, end) for (tx, chrom), (s, end) in spans.items()])
    found = A.flank_coverage(C.transcript_spans(e), b, 3000).collect()
    want = {k: n - body.get(k, 0) for k, n in wide.items()}
    # transcripts before position 1 reach beyond their track
    assert {(r.tx, r.chain): r.flank_cover for r in found} == want and len(found) == len(want)


def test_fragments_and_synteny(spark):
    exons, blocks, e, b = _tables(spark, 7)
    cover = C.block_exon_coverage(e, b)
    n = e.groupBy("tx").agg({"exon": "count"}).selectExpr("tx", "`count(exon)` AS n")
    want = {tuple(r) for r in C.tiling_candidates(cover, n, 3.0).collect()}
    found = [tuple(r) for r in C.fragment_candidates(e, b, 3.0).collect()]
    assert want and set(found) == want and len(found) == len(want)
    genes = spark.createDataFrame([(f"g{t % 7}", f"t{t}") for t in range(50)] + [("other", "t1")], "gene string, tx string")
    of = {}
    for g, t in [tuple(r) for r in genes.collect()]:
        of.setdefault(t, set()).add(g)
    pairs = {(tx, chain) for tx, chain, *_ in _met(exons, blocks) if tx in of}
    want = {c: (len(set().union(*(of[t] for t, x in pairs if x == c))), len({t for t, x in pairs if x == c})) for _, c in pairs}
    assert {r.chain: (r.synt, r.tx_on_chain) for r in C.synteny_counts(e, b, genes).collect()} == want


def test_mapped_exons(spark):
    """Without pairs, the mapping of all overlapping spans equals that of the pairs given."""
    rnd = random.Random(8)
    _, _, e, _ = _tables(spark, 8)
    rows = []
    for chain in range(25):
        at, q, forward = rnd.randrange(-3000, 50000), rnd.randrange(500, 9000), chain % 2 == 0
        low = []
        for blk in range(rnd.randrange(1, 30)):
            size = rnd.randrange(1, 120)
            low.append((blk, at, at + size, q, q + size))
            at, q = at + size + rnd.choice([0, 0, 300, 20000]), q + size + rnd.randrange(0, 900)
        for blk, s, t, a, b in low:
            rows.append((chain, "a" if chain % 3 else "b", blk, s, t, *((a, b) if forward else (200000 - b, 200000 - a)), forward))
    blocks = spark.createDataFrame(rows, "chain bigint, chrom string, blk bigint, b_start bigint, b_end bigint, q_start bigint, q_end bigint, codirected boolean")
    exons = e.filter("exon IS NOT NULL").groupBy("tx", "chrom", "exon").agg({"e_start": "min", "e_end": "max"}).toDF("tx", "chrom", "exon", "e_start", "e_end")
    want = sorted(map(str, C.map_exons(exons, C.chain_transcript_pairs(exons, blocks), blocks).collect()))
    found = sorted(map(str, C.map_exons(exons, None, blocks).collect()))
    assert found == want and {s for s in ("mapped", "gap", "out", "missing") if any(f"state='{s}'" in r for r in want)} == {"mapped", "gap", "out", "missing"}


def test_unaligned_meets_islands(spark):
    """A transcript under many chains meets an island; before, it met every chain."""
    e = spark.createDataFrame([(t, "a" if t < 9 else "b", 0, t * 1000, t * 1000 + 100) for t in range(10)], "tx bigint, chrom string, exon bigint, e_start bigint, e_end bigint")
    b = spark.createDataFrame([(c, "a", 0, 1900 + c, 3050 + c) for c in range(50)] + [(99, "a", 0, 5100, 6000)], "chain bigint, chrom string, blk bigint, b_start bigint, b_end bigint")
    assert {tuple(r) for r in C.unaligned(e, b).collect()} == {(t, "UNALIGNED_TR") for t in (0, 1, 4, 5, 6, 7, 8)} | {(9, "UNCOV_CHROM")}
    plan = C.unaligned(e, b)._jdf.queryExecution().analyzed().toString()
    assert "m_start" in plan and "c_start" in plan


def test_narrowest_gaps_meet_where_they_are_folded(spark):
    """The narrowest gap around each head, lowest chain on ties, against all pairs; no pair is shuffled."""
    import random

    from genoweave.operators import local
    from genoweave.plans import catalogue

    r = random.Random(5)
    heads = [(t, f"c{t % 2}", s, s + r.choice((1, 60, 9000))) for t in range(300) for s in [r.randrange(20000)]]
    gaps = [(c, f"c{r.randrange(2)}", s, s + r.choice((0, 70, 500, 500, 30000))) for c in range(400) for s in [r.randrange(20000) - 5000]]
    want = {}
    for t, chrom, s, e in heads:
        inside = [(ge - gs, c) for c, k, gs, ge in gaps if k == chrom and gs <= s and e <= ge]
        if inside:
            want[t] = min(inside)[1]
    left = spark.createDataFrame(heads, "tx long, chrom string, t_start long, h_end long")
    right = spark.createDataFrame(gaps, "chain long, chrom string, g_start long, g_end long")
    schema = "tx bigint, chain bigint, g_start bigint, g_end bigint"
    found = local.local_overlaps(left, right, ["chrom"], ["tx"], ("t_start", "h_end"), ("g_start", "g_end"), local.narrowest, schema).collect()
    assert {x["tx"]: x["chain"] for x in found} == want and len(found) == len(want) > 100
    assert local.local_overlaps(left, right.limit(0), ["chrom"], ["tx"], ("t_start", "h_end"), ("g_start", "g_end"), local.narrowest, schema).count() == 0
    plan = catalogue.QUERIES["span_precedence"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" not in plan and "MapInArrow" in plan
