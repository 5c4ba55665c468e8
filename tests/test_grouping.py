"""Search groups against a plain walk over the exons of a projection."""

import itertools
import random

from genoweave.operators.grouping import exon_groups, group_combinations, shared_exons


def plain(exons, region, codirected, acc, don, gap):
    """exons {number: (start, end) or None} -> {number: (first, g_start, g_end, s_start, s_end)}."""
    a, b = (acc, don) if codirected else (don, acc)
    space = {n: [max(0, r[0] - a), r[1] + b] for n, r in exons.items() if r}
    order = sorted(space, key=lambda n: (*space[n], n))
    groups = []
    for n in order:
        if groups and space[n][0] - max(space[m][1] for m in groups[-1]) <= gap:
            groups[-1].append(n)
        else:
            groups.append([n])
    cut = {n: list(s) for n, s in space.items()}
    for g in groups:
        for x, y in zip(g, g[1:], strict=False):
            cut[x][1] = max(exons[x][1], min(space[x][1], space[y][0] - 1))
            cut[y][0] = min(exons[y][0], max(space[y][0], space[x][1] + 1))
    coords = [(min(cut[n][0] for n in g), max(cut[n][1] for n in g)) for g in groups]
    of = {n: i for i, g in enumerate(groups) for n in g}
    out = {n: (min(groups[i]), *coords[i], *cut[n]) for n, i in of.items()}
    runs = []
    for n in sorted(n for n, r in exons.items() if not r):
        fits = [i for i, g in enumerate(groups) if min(g) < n < max(g)]
        if fits:
            i = min(fits) if codirected else max(fits)
            out[n] = (min(groups[i]), *coords[i], None, None)
        elif runs and runs[-1][-1] == n - 1:
            runs[-1].append(n)
        else:
            runs.append([n])
    first, last = min(exons), max(exons)
    for r in runs:
        below = coords[of[max(n for n in of if n < r[0])]] if any(n < r[0] for n in of) else None
        above = coords[of[min(n for n in of if n > r[-1])]] if any(n > r[-1] for n in of) else None
        low = region[0] if (r[0] == first if codirected else r[-1] == last) else (below if codirected else above)[1] + 1
        high = region[1] if (r[-1] == last if codirected else r[0] == first) else (above if codirected else below)[0] - 1
        for n in r:
            out[n] = (r[0], low, high, None, None)
    return out


def test_groups(spark):
    rng, rows, regions, want = random.Random(8), [], [], {}
    for tx in range(150):
        codirected, n = tx % 2 == 0, rng.randrange(1, 12)
        exons, at = {}, 300
        for k in range(1, n + 1):
            at += rng.choice([5, 60, 110, 130, 400])
            size = rng.randrange(10, 90)
            exons[k] = None if rng.random() < 0.4 else (at, at + size)
            at += size
        if not codirected:
            exons = {n + 1 - k: v for k, v in exons.items()}
        if tx % 5 == 0:  # an inversion
            mixed = list(exons.values())
            rng.shuffle(mixed)
            exons = dict(zip(exons, mixed, strict=True))
        rows += [(f"t{tx}", 7, k, codirected, *(v or (None, None))) for k, v in exons.items()]
        regions.append((f"t{tx}", 7, 0, at + 500))
        want[f"t{tx}"] = plain(exons, (0, at + 500), codirected, 40, 25, 10)
    df = spark.createDataFrame(rows, "tx string, chain long, exon int, codirected boolean, q_start long, q_end long")
    got = {}
    for r in exon_groups(df, spark.createDataFrame(regions, "tx string, chain long, start long, stop long"), 40, 25).collect():
        got.setdefault(r["tx"], {})[r["exon"]] = (r["first_exon"], r["g_start"], r["g_end"], r["s_start"], r["s_end"])
    assert got == want
    assert exon_groups(df.limit(0), spark.createDataFrame(regions, "tx string, chain long, start long, stop long")).collect() == []


def settle(fragments):
    """fragments {chain: {exon: covered}} -> the same, exon by exon as one meets the next."""
    order = sorted(fragments, key=lambda c: (min(fragments[c]), max(fragments[c]), c))
    left = {c: dict(x) for c, x in fragments.items()}
    for a, b in zip(order, order[1:], strict=False):
        former, latter = left[a], left[b]
        one, other, lost = len(former) == 1, len(latter) == 1, False
        for x in sorted(set(former) & set(latter)):
            if not lost and (one or (former[x] > latter[x] and not other)):
                del latter[x]
            else:
                lost = True
                del former[x]
    return left


def test_shared_exons(spark):
    rng, rows, want = random.Random(3), [], set()
    for tx in range(120):
        fragments = {}
        for chain in range(rng.randrange(1, 6)):
            first = rng.randrange(1, 8)
            fragments[chain] = {x: rng.randrange(0, 6) for x in range(first, first + rng.randrange(1, 6))}
        rows += [(tx, c, x, n or None) for c, f in fragments.items() for x, n in f.items()]
        want |= {(tx, c, x, n) for c, f in settle(fragments).items() for x, n in f.items()}
    df = spark.createDataFrame(rows + rows[:50], "tx int, chain long, exon int, covered int")
    got = [tuple(r) for r in shared_exons(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len(want) < len(rows)
    assert shared_exons(df.limit(0)).collect() == []


def test_combinations(spark):
    rng, rows, want = random.Random(4), [], []
    for tx in range(25):
        groups = {g: [f"a{n}" for n in range(rng.randrange(1, 4))] for g in rng.sample(range(9), rng.randrange(1, 5))}
        rows += [(tx, g, a) for g, alts in groups.items() for a in alts]
        for n, choice in enumerate(itertools.product(*[groups[g] for g in sorted(groups)]), 1):
            want += [(tx, n, g, a) for g, a in zip(sorted(groups), choice, strict=True)]
    df = spark.createDataFrame([*rows, *rows[:5], (3, None, "a"), (4, 1, None)], "tx int, g int, a string")
    assert sorted(tuple(r) for r in group_combinations(df, ["tx"], "g", "a").collect()) == sorted(want)
