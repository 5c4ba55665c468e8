"""Alignment of the exons of a transcript to a genomic locus with a codon model that knows splice sites and introns.

Model. Each exon stands between two introns. An intron emits single bases; it ends with the acceptor
profile or, rarely, without one. A split codon emits its bases, or is skipped. Between it and the
first whole codon bases or codons may be inserted. Each codon matches three bases, loses one or two
of them, or is deleted, alone or in a run of up to ten; after a match bases or codons may be
inserted. Then come the split codon of the other end, the donor profile and the next intron. The
first and last codon of the transcript may be start and stop codons, which only match their kind.
An intron may also be lost.

Search. A row of the score table belongs to a codon and holds its diagonals: positions of the locus
less three times the codon's number. Rows are computed as vectors; insertions, which depend on
earlier cells of their own row, are running maxima of scores less the cost of the way. Introns
lie between the last row of an exon and the first of the next and are running maxima too, so no base
of theirs has a cell. Diagonals are those around the range where an exon is expected, so time and
memory grow with codons times the band, whatever the length of introns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

STOPS = ("TAA", "TAG", "TGA")
NEVER = -np.inf
RUN = 10  # codons that are lost at once, at most
BLOCKED = -1e4  # a codon that no insertion emits; finite, as sums over it must stay exact enough

# Transition probabilities of the model.
FRAMESHIFT = 0.0001
INSERT_CODON, INSERT_MORE, INSERT_AT_SPLICE, INSERT_BASE_MORE = 0.01, 0.2, 0.4, 0.25
DELETE_CODON, DELETE_AT_SPLICE = 0.025, 0.012
DELETE_RUN = (0.432, 0.276, 0.208, 0.164, 0.147, 0.133, 0.127, 0.123, 0.118)  # of 2 to 10 codons, relative to one
INTRON_MORE, NO_LEADING_INTRON, NO_TRAILING_INTRON = 0.9, 0.5, 0.49

# Letters that a consensus letter stands for.
CONSENSUS = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "W": "AT", "N": "ACGT"}


def profile(consensus: str, keep: float = 0.9, strict: str = "") -> list[list[float]]:
    """Probabilities of A, C, G and T along a splice site: consensus letters share ``keep``; all at ``strict`` places ("x")."""
    rows = []
    for i, letter in enumerate(consensus):
        named = CONSENSUS[letter]
        share = 1.0 if strict[i : i + 1] == "x" or len(named) == 4 else keep
        rows.append([share / len(named) if b in named else (1 - share) / (4 - len(named)) for b in "ACGT"])
    return rows


PROFILES = {
    "acceptor": profile("YYYYYYYYYYNYAG", 0.8, "............xx"),
    "donor": profile("GTRAGT", 0.85, "xx...."),
    "none": [[0.25] * 4] * 2,
}


def codes(sequence: str) -> np.ndarray:
    """0 to 3 for A, C, G, T in either case, 4 for all else."""
    table = np.full(256, 4, dtype=np.int64)
    for i, b in enumerate("ACGT"):
        table[[ord(b), ord(b.lower())]] = i
    return table[np.frombuffer(sequence.encode("ascii", "replace"), dtype=np.uint8)]


def codon_table(keep: float = 0.88, decay: float = 0.08, stop: float = 0.0002) -> np.ndarray:
    """P(query codon | reference codon), 64 x 64: ``keep`` for itself, the rest falls by ``decay`` with every further base.

    Stop codons share ``stop``. A table that was read or estimated can take its place.
    """
    bases = np.array([[i // 16, i // 4 % 4, i % 4] for i in range(64)])
    differ = (bases[:, None, :] != bases[None, :, :]).sum(axis=2)
    ends = np.array(["".join("ACGT"[b] for b in row) in STOPS for row in bases])
    weight = np.where(differ == 0, 0.0, decay**differ) * ~ends[None, :]
    out = weight / weight.sum(axis=1, keepdims=True) * (1 - keep - stop)
    out[:, ends] = stop / ends.sum()
    out[np.arange(64), np.arange(64)] += keep
    return out / out.sum(axis=1, keepdims=True)


def _with_unknown(table: np.ndarray) -> np.ndarray:
    """A table over codons of four letters -> over codons of five, whose last letter stands for all four alike."""
    spread = np.zeros((5, 4))
    spread[:4, :4] = np.eye(4)
    spread[4] = 0.25
    three = np.einsum("ai,bj,ck->abcijk", spread, spread, spread).reshape(125, 64)
    return three @ table @ three.T if table.shape == (64, 64) else three @ table


@dataclass(frozen=True)
class Model:
    """Scores of the model: logarithms of its probabilities."""

    table: np.ndarray = field(default_factory=codon_table)
    profiles: dict[str, list[list[float]]] = field(default_factory=lambda: dict(PROFILES))

    @cached_property
    def cost(self) -> dict[str, float]:
        one = 1.0
        p = {
            "shift": FRAMESHIFT,
            "kept": one - FRAMESHIFT,
            "match": one - 2 * FRAMESHIFT - DELETE_CODON,
            "match_on": one - FRAMESHIFT - INSERT_CODON,
            "ins3": INSERT_CODON,
            "ins3_more": INSERT_MORE,
            "ins3_on": one - INSERT_MORE,
            "ins3_end_on": one - INSERT_AT_SPLICE,
            "ins3_splice": INSERT_AT_SPLICE,
            "ins1_more": INSERT_BASE_MORE,
            "ins1_on": one - INSERT_BASE_MORE,
            "splice_on": one - FRAMESHIFT - INSERT_AT_SPLICE,
            "lost": DELETE_CODON / (1 + sum(DELETE_RUN)),
            "lost_splice": DELETE_AT_SPLICE,
            "more": INTRON_MORE,
            "lead": (one - FRAMESHIFT) * NO_LEADING_INTRON,
            "acceptor": one - INTRON_MORE - FRAMESHIFT,
            "donor": one - 2 * FRAMESHIFT - FRAMESHIFT**2,
            "donor_last": one - 2 * FRAMESHIFT,
            "intron_lost": FRAMESHIFT**2,
            "trail": one - NO_TRAILING_INTRON,
            "end": NO_TRAILING_INTRON,
            "intron_end": one - INTRON_MORE,
            "base": 0.25,
        }
        return {k: float(np.log(v)) for k, v in p.items()}

    @cached_property
    def runs(self) -> np.ndarray:
        """Of deletions of 1 to RUN codons, relative to one."""
        return np.log([1.0, *DELETE_RUN])

    @cached_property
    def emit(self) -> np.ndarray:
        """Codon against codon; a last column for what isn't inside the locus."""
        return np.column_stack((np.log(_with_unknown(self.table)), np.full(125, NEVER)))

    @cached_property
    def insert(self) -> np.ndarray:
        """An inserted codon: as often as any reference codon turns into it; stop codons never."""
        mean = self.table.mean(axis=0)
        mean = np.where([f"{'ACGT'[i // 16]}{'ACGT'[i // 4 % 4]}{'ACGT'[i % 4]}" in STOPS for i in range(64)], np.exp(BLOCKED), mean / mean.sum())
        with np.errstate(divide="ignore"):
            return np.append(np.maximum(np.log(_with_unknown(mean)), BLOCKED), BLOCKED)

    @cached_property
    def sites(self) -> dict[str, np.ndarray]:
        with np.errstate(divide="ignore"):
            return {k: np.log(np.column_stack((v, np.mean(v, axis=1), np.zeros(len(v))))) for k, v in self.profiles.items()}


@dataclass
class Exon:
    """An exon: its letters, how many of the first belong to a split codon, where it is expected, and its splice sites."""

    seq: str
    phase: int = 0
    lo: int | None = None
    hi: int | None = None
    acceptor: str = "acceptor"
    donor: str = "donor"


@dataclass
class Found:
    """Where an exon was found, its rows of the alignment, and whether it lies between splice sites."""

    start: int
    end: int
    ref: str
    query: str
    acceptor: bool
    donor: bool


class _Locus:
    """Letters and codons of a locus, with room on both sides so that any band is a slice."""

    def __init__(self, sequence: str):
        self.text, self.n = sequence.upper(), len(sequence)
        self.code = codes(sequence)

    def padded(self, values: np.ndarray, first: int, n: int, fill: float) -> np.ndarray:
        out = np.full(n, fill, dtype=values.dtype)
        a, b = max(first, 0), min(first + n, len(values))
        if a < b:
            out[a - first : b - first] = values[a:b]
        return out

    @cached_property
    def codons(self) -> np.ndarray:
        """By the position after a codon: its number; 125 where there is none."""
        c = self.code
        out = np.full(self.n + 1, 125, dtype=np.int64)
        out[3:] = c[:-2] * 25 + c[1:-1] * 5 + c[2:] if self.n >= 3 else out[3:]
        return out

    @cached_property
    def inside(self) -> np.ndarray:
        return np.zeros(self.n + 1)

    def site(self, scores: np.ndarray, first: int, n: int) -> np.ndarray:
        """Score of a profile that ends at each of the positions first .. first + n - 1."""
        total = self.padded(self.inside, first, n, NEVER)
        for j, row in enumerate(scores):
            total = total + row[self.padded(self.code, first - len(scores) + j, n, 5)]
        return np.where(self.padded(self.inside, first - len(scores), n, NEVER) == NEVER, NEVER, total)

    def kind(self, codons: tuple[str, ...], first: int, n: int) -> np.ndarray:
        """0 less the log of their number where one of the codons ends, else never."""
        wanted = [int(codes(c) @ (25, 5, 1)) for c in codons]
        return np.where(np.isin(self.padded(self.codons, first, n, 125), wanted), -np.log(len(codons)), NEVER)


def _scan1(x: np.ndarray, step: float) -> np.ndarray:
    """max over s < i of x[s] + (i - s) * step."""
    at = np.arange(len(x)) * step
    best = np.maximum.accumulate(x - at)
    return np.concatenate(([NEVER], best[:-1])) + at


def _scan3(x: np.ndarray, more: np.ndarray) -> np.ndarray:
    """max over m >= 1 of x[i - 3 m] + the sum of more over the m places i - 3 (m - 1) .. i."""
    rows = -(-len(x) // 3)
    way, best = np.zeros((rows, 3)), np.full((rows, 3), NEVER)
    way.ravel()[: len(x)] = more
    best.ravel()[: len(x)] = x
    np.cumsum(way, axis=0, out=way)
    best -= way
    np.maximum.accumulate(best, axis=0, out=best)
    way[1:] += best[:-1]
    way[0] = NEVER
    return way.ravel()[: len(x)]


class _Part:
    """Scores of one exon over its diagonals."""

    def __init__(self, model: Model, locus: _Locus, exon: Exon, band: int, first: bool, last: bool):
        self.m, self.c, self.locus, self.exon, self.last = model, model.cost, locus, exon, last
        self.seq = exon.seq.upper()
        n = len(self.seq)
        self.start = first and exon.phase == 0 and self.seq[:3] == "ATG"
        phase = min(exon.phase, n)
        tail = (n - phase) % 3
        self.stop = last and tail == 0 and n - phase >= 3 + 3 * self.start and self.seq[-3:] in STOPS
        self.head, self.tail = (3 if self.start else phase), (3 if self.stop else tail)
        inner = codes(self.seq[self.head : n - self.tail])
        self.codons = (inner.reshape(-1, 3) @ (25, 5, 1)).astype(np.int64) if len(inner) else np.zeros(0, np.int64)
        lo, hi = (0, locus.n) if exon.lo is None or exon.hi is None else (exon.lo, exon.hi)
        if exon.lo is None or exon.hi is None:
            self.d0, self.d1 = -n, locus.n + n
        else:
            self.d0, self.d1 = min(lo, hi - n) - band, max(lo, hi - n) + band
        self.width = self.d1 - self.d0 + 1

    def first_position(self, k: int) -> int:
        """Of row k: what is consumed of the locus on its first diagonal."""
        return self.d0 + self.head + 3 * k

    def enter(self, a: np.ndarray) -> None:
        """a: scores before the split codon, at positions d0 .. d1 + head."""
        c, w = self.c, self.width
        at = self.first_position(0)
        self.a = a
        if self.start:
            self.whole = a[:w] + c["kept"] + self.locus.kind(("ATG",), at, w)
        else:
            self.whole = a[:w] + c["kept"] + self.head * c["base"]
        self.skipped = a[self.head :] + c["shift"]
        self.b = np.maximum(self.whole, self.skipped)
        self.b = self.b + self.locus.padded(self.locus.inside, at, w, NEVER)
        n = len(self.codons)
        # row k stands at k + RUN, with room behind it, so that runs of lost codons are a slanted view
        self.cells = np.full((n + RUN + 1, w + 3 * RUN + 3), NEVER)
        self.rows = self.cells[RUN:, :w]
        self.rows[0] = self.opened()[0]
        for k in range(1, n + 1):
            self.rows[k] = self.codon(k)
        end = self.rows[n]
        self.done_at = self.first_position(len(self.codons))
        wide = np.full(w + self.tail, NEVER)
        self.ended = wide.copy()
        last = self.locus.kind(STOPS, self.done_at + self.tail, w) if self.stop else self.tail * c["base"]
        self.ended[self.tail :] = end + c["kept"] + last
        self.cut = wide
        self.cut[:w] = end + c["shift"]
        self.d = np.maximum(self.ended, self.cut) + self.locus.padded(self.locus.inside, self.done_at, w + self.tail, NEVER)

    def codons_at(self, k: int) -> np.ndarray:
        at = self.first_position(k)
        if 0 <= at and at + self.width <= self.locus.n + 1:
            return self.locus.codons[at : at + self.width]
        return self.locus.padded(self.locus.codons, at, self.width, 125)

    def bounded(self, row: np.ndarray, k: int) -> np.ndarray:
        """The row without what lies outside the locus."""
        at = self.first_position(k)
        if at < 0:
            row[:-at] = NEVER
        if at + self.width > self.locus.n + 1:
            row[max(0, self.locus.n + 1 - at) :] = NEVER
        return row

    def opened(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Row 0, and its ways: straight on, or inserted codons or bases behind the splice site."""
        c = self.c
        ins1 = _scan1(self.b, c["ins1_more"] + c["base"]) + (c["shift"] - c["ins1_more"] + c["ins1_on"])
        ins3 = _scan3(self.b, c["ins3_splice"] + self.m.insert[self.codons_at(0)]) + c["ins3_end_on"]
        ways = [self.b + c["splice_on"], ins3, ins1]
        return self.bounded(np.maximum.reduce(ways), 0), ways

    def matched(self, k: int, here: np.ndarray) -> np.ndarray:
        return self.rows[k - 1] + (self.c["match"] + self.m.emit[self.codons[k - 1]])[here]

    def insertions(self, match: np.ndarray, k: int, here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores behind codons and bases that are inserted after codon k."""
        c = self.c
        more, on = ("ins3_splice", "ins3_end_on") if k == len(self.codons) else ("ins3_more", "ins3_on")
        ins3 = _scan3(match, (c[more] + self.m.insert)[here]) + (c["ins3"] - c[more] + c[on])
        return ins3, _scan1(match, c["ins1_more"] + c["base"]) + (c["shift"] - c["ins1_more"] + c["ins1_on"])

    def lost(self, k: int) -> np.ndarray:
        """Scores behind 1 to 10 lost codons, the last of them k: a view of earlier rows, each three diagonals further."""
        view = np.lib.stride_tricks.as_strided(self.cells[k + RUN - 1, 3:], (RUN, self.width), ((3 - self.cells.shape[1]) * 8, 8))
        one = np.full(RUN, self.c["lost_splice" if k == len(self.codons) else "lost"])
        if k <= RUN:
            one[k - 1] = self.c["lost_splice"]
        return view + (one + self.m.runs)[:, None]

    def shifted(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores behind codon k with one or two of its bases lost."""
        row, c = self.cells[k + RUN - 1], self.c
        return row[1 : self.width + 1] + (c["shift"] + 2 * c["base"]), row[2 : self.width + 2] + (c["shift"] + c["base"])

    def codon(self, k: int) -> np.ndarray:
        """Row k: the best of a match, insertions behind it, lost bases and lost codons."""
        here = self.codons_at(k)
        match = self.matched(k, here)
        row = self.lost(k).max(axis=0)
        for way in (match + self.c["match_on"], *self.insertions(match, k, here), *self.shifted(k)):
            np.maximum(row, way, out=row)
        return self.bounded(row, k)

    def way(self, k: int, i: int) -> int:
        """What led to diagonal i of row k: 0 a match, 1 and 2 inserted codons and bases, 3 and 4 one and two lost bases, from 5 on lost codons."""
        here = self.codons_at(k)
        match = self.rows[k - 1, i] + self.c["match"] + self.m.emit[self.codons[k - 1]][here[i]] + self.c["match_on"]
        if match >= self.rows[k, i] - 1e-9:
            return 0
        ways = [*self.insertions(self.matched(k, here), k, here), *self.shifted(k)]
        return 1 + int(np.argmax([*(w[i] for w in ways), *self.lost(k)[:, i]]))

    def donor(self) -> None:
        """Scores behind the donor profile, and where the next intron may begin, from done_at on."""
        scores = self.m.sites[self.exon.donor]
        self.donor_size = len(scores)
        size = len(self.d) + self.donor_size
        self.after = np.full(size, NEVER)
        self.after[self.donor_size :] = self.d + self.c["donor_last" if self.last else "donor"]
        self.after = self.after + self.locus.site(scores, self.done_at, size)
        self.plain = np.full(size, NEVER)
        self.plain[: len(self.d)] = self.d + self.c["shift"]
        self.begun = np.maximum(self.after + self.c["trail"], self.plain)


class Alignment:
    """The best path of a transcript's exons through a locus; ``score`` is NEVER if there is none."""

    def __init__(self, model: Model, locus: str, exons: list[Exon], band: int):
        self.m, self.c = model, model.cost
        self.locus = _Locus(locus)
        self.parts = [_Part(model, self.locus, e, band, i == 0, i == len(exons) - 1) for i, e in enumerate(exons)]
        self.step = self.c["base"] + self.c["more"]
        for i, part in enumerate(self.parts):
            part.enter(self._before(i)[0])
            part.donor()
        self.score, self._last = self._end()

    def _intron(self, i: int, first: int, n: int) -> np.ndarray:
        """Scores after at least one base of the intron before exon i, at positions first .. first + n - 1."""
        at = np.arange(first, first + n)
        inside = self.locus.padded(self.locus.inside, first, n, NEVER)
        if i == 0:
            return np.where(at >= 1, self.c["lead"] + at * self.step - self.c["more"], NEVER) + inside
        p = self.parts[i - 1]
        best = np.maximum.accumulate(p.begun - np.arange(p.done_at, p.done_at + len(p.begun)) * self.step)
        last = np.minimum(at - 1 - p.done_at, len(best) - 1)
        return np.where(last >= 0, best[np.maximum(last, 0)] + at * self.step - self.c["more"], NEVER) + inside

    def _before(self, i: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores before the split codon of exon i: without a profile, behind one, without an intron, from the very start."""
        p, c = self.parts[i], self.c
        first, n = p.d0, p.width + p.head
        scores = self.m.sites[p.exon.acceptor]
        p.acceptor_size = size = len(scores)
        site = self.locus.site(scores, first, n)
        ways = [self._intron(i, first, n) + c["shift"], self._intron(i, first - size, n) + c["acceptor"] + site]
        at = np.arange(first, first + n)
        if i == 0:
            ways += [np.where(at == size, c["lead"], NEVER) + site, np.where(at == 0, c["shift"], NEVER)]
        else:
            q = self.parts[i - 1]
            ways.append(self.locus.padded(q.d, first - q.done_at, n, NEVER) + c["intron_lost"])
        return np.maximum.reduce(ways) + self.locus.padded(self.locus.inside, first, n, NEVER), ways

    def _end(self) -> tuple[float, int]:
        p, n, c = self.parts[-1], self.locus.n, self.c
        get = lambda row: float(row[n - p.done_at]) if 0 <= n - p.done_at < len(row) else NEVER
        trail = p.begun - np.arange(p.done_at, p.done_at + len(p.begun)) * self.step
        trail = trail[: max(0, n - p.done_at)]
        ways = [float(trail.max()) + n * self.step - c["more"] + c["intron_end"] if len(trail) else NEVER, get(p.d) + c["shift"], get(p.after) + c["end"]]
        return max(ways), int(np.argmax(ways))

    def _begun(self, i: int, before: int) -> tuple[int, bool]:
        """Where the intron behind exon i begins, if its bases end at ``before``: position of the exon's end, with a donor?"""
        p = self.parts[i]
        gain = p.begun - np.arange(p.done_at, p.done_at + len(p.begun)) * self.step
        k = int(np.argmax(gain[: before - p.done_at]))
        with_donor = p.after[k] + self.c["trail"] >= p.plain[k]
        return p.done_at + k - (p.donor_size if with_donor else 0), bool(with_donor)

    def found(self) -> list[Found]:
        """The exons along the best path."""
        if self.score == NEVER:
            return []
        p, n = self.parts[-1], self.locus.n
        end, donor = self._begun(len(self.parts) - 1, n) if self._last == 0 else (n, False) if self._last == 1 else (n - p.donor_size, True)
        out = []
        for i in range(len(self.parts) - 1, -1, -1):
            p = self.parts[i]
            start, ref, query = self._walk(p, end)
            total, ways = self._before(i)
            way = int(np.argmax([w[start - p.d0] for w in ways]))
            out.append(Found(start, end, ref, query, way == 1 or i == 0 and way == 2, donor))
            if i and way == 2:
                end, donor = start, False
            elif i:
                end, donor = self._begun(i - 1, start - (p.acceptor_size if way == 1 else 0))
        return out[::-1]

    def _walk(self, p: _Part, end: int) -> tuple[int, str, str]:
        """Back through an exon: its start, and the reference and query rows of the alignment."""
        text, seq = self.locus.text, p.seq
        ref, query = [], []
        k, q = len(p.codons), end
        i = end - p.done_at
        tail = seq[len(seq) - p.tail :]
        if p.ended[i] >= p.cut[i]:
            i, q = i - p.tail, end - p.tail
            ref.append(tail)
            query.append(text[q:end])
        else:
            ref.append(tail)
            query.append("-" * p.tail)
        while k > 0:
            way = p.way(k, i)
            codon = seq[p.head + 3 * (k - 1) : p.head + 3 * k]
            if way >= 5:  # runs of lost codons
                j = way - 4
                ref.append(seq[p.head + 3 * (k - j) : p.head + 3 * k])
                query.append("-" * 3 * j)
                k, i = k - j, i + 3 * j
                continue
            if way in (3, 4):
                kept = 5 - way
                ref.append(codon)
                query.append(_placed(codon, text[q - kept : q]))
                k, i, q = k - 1, i + 3 - kept, q - kept
                continue
            if way:  # inserted behind the match
                n = self._inserted(p, k, i, 3 if way == 1 else 1)
                ref.append("-" * n)
                query.append(text[q - n : q])
                i, q = i - n, q - n
            ref.append(codon)
            query.append(text[q - 3 : q])
            k, q = k - 1, q - 3
        _, ways = p.opened()
        way = int(np.argmax([w[i] for w in ways]))
        if way:
            n = self._inserted(p, 0, i, 3 if way == 1 else 1)
            ref.append("-" * n)
            query.append(text[q - n : q])
            i, q = i - n, q - n
        head = seq[: p.head]
        ref.append(head)
        if p.whole[i] >= p.skipped[i]:
            query.append(text[q - p.head : q])
            q -= p.head
        else:
            query.append("-" * p.head)
        return q, "".join(ref[::-1]), "".join(query[::-1])

    def _inserted(self, p: _Part, k: int, i: int, by: int) -> int:
        """How many bases the best insertion that ends on diagonal i of row k has."""
        here = p.codons_at(k)
        x = p.matched(k, here) if k else p.b
        if by == 1:
            n = np.arange(1, i + 1)
            return int(n[np.argmax(x[i - n] + n * (self.c["ins1_more"] + self.c["base"]))])
        more = self.c["ins3_splice" if k in (0, len(p.codons)) else "ins3_more"] + self.m.insert[here]
        n = np.arange(3, i + 1, 3)
        return int(n[np.argmax(x[i - n] + np.cumsum(more[i - n + 3]))])


def _placed(codon: str, kept: str) -> str:
    """The kept bases of a codon, with gaps where most of them agree with it; the first such place."""
    if len(kept) == 2:
        ways = ["-" + kept, kept[0] + "-" + kept[1], kept + "-"]
    else:
        ways = [kept + "--", "-" + kept + "-", "--" + kept]
    return max(ways, key=lambda w: sum(a == b for a, b in zip(codon, w, strict=True)))


@lru_cache(maxsize=1)
def default_model() -> Model:
    return Model()


def align_exons(rows: DataFrame, key: str, model: Model | None = None, band: int = 64) -> DataFrame:
    """rows (key, locus, exons) -> (key, exon, q_start, q_end, ref_aligned, query_aligned, has_acceptor, has_donor, score).

    exons is an array of struct (seq, phase, lo, hi), or with the names of an ``acceptor`` and a ``donor``
    profile: the letters of each exon in order, how many of the first end a split codon, and the range
    of the locus where it is expected (null: anywhere). The path may leave that range by ``band`` bases
    on either side. There is a row for each exon, numbered from 1, its range null if the locus is too
    short for any path; score is that of the whole transcript. Null sequences are empty, letters but
    A, C, G and T stand for any base. A row is aligned where it is read; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = model or default_model()
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for i, (locus, exons) in enumerate(zip(batch["locus"].to_pylist(), batch["exons"].to_pylist(), strict=True)):
                asked = [Exon(e["seq"] or "", e["phase"] or 0, e["lo"], e["hi"], e.get("acceptor") or "acceptor", e.get("donor") or "donor") for e in exons or []]
                if not asked:
                    continue
                done = Alignment(use, locus or "", asked, band)
                found = done.found() or [None] * len(asked)
                for number, f in enumerate(found, 1):
                    cells = (f.start, f.end, f.ref, f.query, f.acceptor, f.donor, done.score) if f else (None,) * 7
                    for column, x in zip(out, (i, number, *cells), strict=True):
                        column.append(x)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.float64())
            cols = [pa.array(c, k) for c, k in zip(out[1:], kinds, strict=True)]
            names = [key, "exon", "q_start", "q_end", "ref_aligned", "query_aligned", "has_acceptor", "has_donor", "score"]
            yield pa.RecordBatch.from_arrays([batch[key].take(pa.array(out[0], pa.int64())), *cols], names)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "locus", "exons").mapInArrow(run, f"{key} {kind}, exon int, q_start bigint, q_end bigint, ref_aligned string, query_aligned string, has_acceptor boolean, has_donor boolean, score double")
