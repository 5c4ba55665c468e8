"""The codon model against an exhaustive search over the paths of its state graph."""

import math
import random
from functools import lru_cache

import pytest

from genoweave.operators import splice_hmm as h

MODEL = h.Model(profiles={"acceptor": h.profile("NYAG", 0.8, "..xx"), "donor": h.profile("GTR", 0.85, "xx."), "none": h.PROFILES["none"]})


def codon_score(table, ref, query):
    """Mean over what unknown letters stand for."""
    spread = lambda c: ["ACGT".index(c)] if c in "ACGT" else range(4)
    every = lambda s: [16 * a + 4 * b + c for a in spread(s[0]) for b in spread(s[1]) for c in spread(s[2])]
    r, q = every(ref), every(query)
    return sum(sum(table[i][j] for j in q) / len(q) for i in r) / len(r)


def inserted(table, query):
    cols = [sum(row[j] for row in table) / 64 for j in range(64)]
    spread = [["ACGT".index(c)] if c in "ACGT" else range(4) for c in query]
    every = [16 * a + 4 * b + c for a in spread[0] for b in spread[1] for c in spread[2]]
    stop = {"ACGT".index(s[0]) * 16 + "ACGT".index(s[1]) * 4 + "ACGT".index(s[2]) for s in h.STOPS}
    total = sum(0.0 if j in stop else cols[j] / sum(cols) for j in every) / len(every)
    return max(math.log(total), h.BLOCKED) if total else h.BLOCKED


def graph(exons):
    """state -> (emission, [(state before, probability)]); emission (bases, function of them)."""
    flat = lambda n: (n, lambda _: 0.25**n)
    silent = (0, lambda _: 1.0)
    s = {}
    table, fs = MODEL.table, h.FRAMESHIFT
    lost = h.DELETE_CODON / (1 + sum(h.DELETE_RUN))
    lead = (1 - fs) * h.NO_LEADING_INTRON
    for i, (seq, phase) in enumerate(exons):
        first, last = i == 0, i == len(exons) - 1
        start = first and phase == 0 and seq[:3] == "ATG"
        tail = (len(seq) - phase) % 3
        stop = last and tail == 0 and seq[-3:] in h.STOPS and len(seq) - phase >= 3 + 3 * start
        head, tail = 3 if start else phase, 3 if stop else tail
        inner = seq[head : len(seq) - tail]
        codons = [inner[j : j + 3] for j in range(0, len(inner), 3)]
        into = [("BEGIN", lead)] if first else [(("don", i - 1, 2), 1 - h.NO_TRAILING_INTRON), (("bsd", i - 1), fs)]
        s["int", i] = (flat(1), [*into, (("int", i), h.INTRON_MORE)])
        site = MODEL.profiles["acceptor"]
        for j, row in enumerate(site):
            before = [(("acc", i, j - 1), 1.0)] if j else [(("int", i), 1 - h.INTRON_MORE - fs), *([("BEGIN", lead)] if first else [])]
            s["acc", i, j] = ((1, lambda b, row=row: row["ACGT".index(b)] if b in "ACGT" else sum(row) / 4), before)
        s["bas", i] = (silent, [(("int", i), fs), (("acc", i, len(site) - 1), 1.0), ("BEGIN", fs) if first else (("bsd", i - 1), fs**2)])
        s["sca", i] = ((3, lambda b: float(b == "ATG")) if start else flat(head), [(("bas", i), 1 - fs)])
        s["bsi", i] = (silent, [(("sca", i), 1.0), (("bas", i), fs)])
        s["ia1", i] = (flat(1), [(("bsi", i), fs), (("ia1", i), h.INSERT_BASE_MORE)])
        s["ia3", i] = ((3, lambda b: math.exp(inserted(table, b))), [(("bsi", i), h.INSERT_AT_SPLICE), (("ia3", i), h.INSERT_AT_SPLICE)])
        s["end", i, 0] = (silent, [(("bsi", i), 1 - fs - h.INSERT_AT_SPLICE), (("ia1", i), 1 - h.INSERT_BASE_MORE), (("ia3", i), 1 - h.INSERT_AT_SPLICE)])
        for k, codon in enumerate(codons, 1):
            more = h.INSERT_AT_SPLICE if k == len(codons) else h.INSERT_MORE
            s["m", i, k] = ((3, lambda b, codon=codon: codon_score(table, codon, b)), [(("end", i, k - 1), 1 - 2 * fs - h.DELETE_CODON)])
            s["i3", i, k] = ((3, lambda b: math.exp(inserted(table, b))), [(("m", i, k), h.INSERT_CODON), (("i3", i, k), more)])
            s["i1", i, k] = (flat(1), [(("m", i, k), fs), (("i1", i, k), h.INSERT_BASE_MORE)])
            s["d1", i, k] = (flat(2), [(("end", i, k - 1), fs)])
            s["d2", i, k] = (flat(1), [(("end", i, k - 1), fs)])
            before = [(("m", i, k), 1 - fs - h.INSERT_CODON), (("i3", i, k), 1 - more), (("i1", i, k), 1 - h.INSERT_BASE_MORE), (("d1", i, k), 1.0), (("d2", i, k), 1.0)]
            for j in range(1, min(10, k) + 1):
                one = h.DELETE_AT_SPLICE if k == len(codons) or j == k else lost
                before.append((("end", i, k - j), one * (1.0 if j == 1 else h.DELETE_RUN[j - 2])))
            s["end", i, k] = (silent, before)
        s["scd", i] = ((3, lambda b: (b in h.STOPS) / 3) if stop else flat(tail), [(("end", i, len(codons)), 1 - fs)])
        s["bsd", i] = (silent, [(("scd", i), 1.0), (("end", i, len(codons)), fs)])
        for j, row in enumerate(MODEL.profiles["donor"]):
            before = [(("don", i, j - 1), 1.0)] if j else [(("bsd", i), 1 - 2 * fs - (0 if last else fs**2))]
            s["don", i, j] = ((1, lambda b, row=row: row["ACGT".index(b)] if b in "ACGT" else sum(row) / 4), before)
    e = len(exons) - 1
    s["trail"] = (flat(1), [(("don", e, 2), 1 - h.NO_TRAILING_INTRON), (("bsd", e), fs), ("trail", h.INTRON_MORE)])
    s["END"] = (silent, [("trail", 1 - h.INTRON_MORE), (("bsd", e), fs), (("don", e, 2), h.NO_TRAILING_INTRON)])
    return s


def exhaustive(locus, exons):
    states = graph(exons)

    @lru_cache(maxsize=None)
    def best(state, at):
        if state == "BEGIN":
            return 0.0 if at == 0 else -math.inf
        (n, emit), before = states[state]
        if n > at:
            return -math.inf
        p = emit(locus[at - n : at])
        if not p:
            return -math.inf
        return math.log(p) + max(best(b, at - n) + math.log(q) for b, q in before)

    return best("END", len(locus))


def check(locus, exons, found):
    at = 0
    for (seq, _), f in zip(exons, found, strict=True):
        assert f.ref.replace("-", "") == seq and f.query.replace("-", "") == locus[f.start : f.end]
        assert len(f.ref) == len(f.query) and at <= f.start <= f.end
        at = f.end


@pytest.mark.parametrize("seed", range(4))
def test_equals_exhaustive_search(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("ACGTACGTACGTACGTN") for _ in range(n))
    for _ in range(12):
        exons = [(letters(rng.randrange(0, 13)), rng.randrange(3)) for _ in range(rng.randrange(1, 4))]
        exons = [(s, min(p, len(s))) for s, p in exons]
        if rng.random() < 0.5:
            exons[0] = ("ATG" + exons[0][0], 0)
        if rng.random() < 0.5:
            s, p = exons[-1]
            exons[-1] = (s[: len(s) - (len(s) - p) % 3] + rng.choice(h.STOPS), p)
        locus = letters(rng.randrange(0, 6))
        for s, _ in exons:
            cut = rng.randrange(len(s) + 1)
            locus += "CCAG" + s[:cut] + letters(rng.randrange(3)) + s[cut + rng.randrange(4) :] + "GTA" + letters(rng.randrange(8))
        done = h.Alignment(MODEL, locus, [h.Exon(s, p) for s, p in exons], 8)
        want = exhaustive(locus, exons)
        assert done.score == pytest.approx(want, abs=1e-6)
        check(locus, exons, done.found())


def test_long_introns_cost_no_cells():
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    codons = lambda n: "".join(rng.choice([a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT" if a + b + c not in h.STOPS]) for _ in range(n))
    one, two, three = "ATG" + codons(40) + "G", codons(30) + "C", codons(50) + "TAA"
    two = "CA" + two
    left, right = letters(200_000), letters(300_000)
    intron = lambda x: "GTAAGT" + x + "TCTTTCCTTTTCAG"
    changed = two[:32] + two[47:]  # five codons are lost
    locus = "CAG" + one + intron(left) + changed + intron(right) + three + "GTAAGT"
    at = [locus.index(x) for x in (one, changed, three)]
    exons = [h.Exon(one, 0, at[0], at[0] + len(one)), h.Exon(two, 2, at[1], at[1] + len(two)), h.Exon(three, 0, at[2] + 9, at[2] + len(three))]
    done = h.Alignment(h.default_model(), locus, exons, 64)
    found = done.found()
    assert [(f.start, f.end) for f in found] == [(a, a + n) for a, n in zip(at, (len(one), len(changed), len(three)), strict=True)]
    assert found[1].query.count("-") == 15 and found[1].acceptor and found[1].donor and found[2].query == three
    assert all(len(r) <= 64 * 2 + 1 + 20 for p in done.parts for r in p.rows)


def test_rows(spark):
    kind = "id long, locus string, exons array<struct<seq:string,phase:int,lo:int,hi:int>>"
    rows = [(1, "CCAGATGAAACCCGTAAGT", [("ATGAAACCC", 0, 4, 13)]), (2, None, [(None, None, None, None)]), (3, "ACGT", None), (4, "ACGT", []), (None, "nnnACG", [("acg", 0, None, None)]), (5, "", [("ACG", 0, 500, 503)])]
    got = {r["id"]: r for r in h.align_exons(spark.createDataFrame(rows, kind), "id").collect()}
    assert (got[1]["q_start"], got[1]["q_end"], got[1]["query_aligned"]) == (4, 13, "ATGAAACCC")
    assert set(got) == {1, 2, None, 5} and got[5]["q_start"] is None
    assert h.align_exons(spark.createDataFrame([], kind), "id").collect() == []


def test_gap_in_a_codon_goes_where_most_bases_agree():
    assert h._placed("ACG", "AG") == "A-G" and h._placed("ACG", "CG") == "-CG" and h._placed("ACG", "C") == "-C-" and h._placed("AAA", "T") == "T--"
