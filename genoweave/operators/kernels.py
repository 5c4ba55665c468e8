"""Sequential kernels that columns can't express, run in Arrow batches or key groups."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERLAP = 250  # bases by which chains of one path may overlap


def best_tiling(chains: DataFrame) -> DataFrame:
    """chains (tx, chain, c_start, c_end, score) -> (tx, chain, step): the path of the highest score.

    Chains of a path follow each other by reference position with at most OVERLAP shared bases. Ties
    take the path of the fewer chains, then of the lower ids.
    """

    def tile(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["c_end", "c_start", "chain"]).reset_index(drop=True)
        ends, starts, score = g["c_end"].to_numpy(), g["c_start"].to_numpy(), g["score"].to_numpy()
        best, back, top = np.zeros(len(g), dtype=np.int64), np.full(len(g), -1), np.empty(len(g), dtype=np.int64)
        for i in range(len(g)):
            j = min(int(np.searchsorted(ends, starts[i] + OVERLAP, side="right")), i) - 1  # predecessors end by then
            before = top[j] if j >= 0 else -1
            best[i] = score[i] + (best[before] if before >= 0 else 0)
            back[i] = before
            top[i] = i if i == 0 or best[i] > best[top[i - 1]] else top[i - 1]
        path, i = [], int(top[-1])
        while i >= 0:
            path.append(i)
            i = int(back[i])
        out = g.iloc[path[::-1]]
        return pd.DataFrame({"tx": out["tx"], "chain": out["chain"], "step": np.arange(1, len(path) + 1)})

    kind = chains.schema["tx"].dataType.simpleString()
    return chains.groupBy("tx").applyInPandas(tile, f"tx {kind}, chain bigint, step bigint")


# Log odds of the codon model.
MATCH, MISMATCH, FRAMESHIFT, CODON_INSERT, CODON_EXTEND, CODON_DELETE = np.log([0.9, 0.1 / 3, 1e-4, 0.01, 0.2, 0.025])


CELLS = 1 << 24  # of the score table of pairs that are aligned together
TASK_ROWS = 250_000  # rows that a task of the fit of trees holds


def _align_together(refs: list[str], queries: list[str]) -> list[tuple[str, str, float]]:
    """Alignments of pairs of one reference length and one query length, cell by cell for all of them."""
    n, m, size = len(refs[0]), len(queries[0]), len(refs)
    r, q = (np.array([list(map(ord, x)) for x in side], dtype=np.int32).reshape(size, -1) for side in (refs, queries))
    score = np.full((n + 1, m + 1, size), -np.inf)
    move = np.zeros((n + 1, m + 1, size), dtype=np.int8)
    score[0, 0] = 0.0
    steps = ((1, 1, 0), (0, 3, CODON_INSERT), (3, 0, CODON_DELETE), (0, 1, FRAMESHIFT), (1, 0, FRAMESHIFT))
    for i in range(n + 1):
        for j in range(m + 1):
            for k, (di, dj, cost) in enumerate(steps):
                if i >= di and j >= dj and (i or j) and not (k == 2 and i % 3):
                    gain = cost
                    if k == 0:
                        gain = np.where(r[:, i - 1] == q[:, j - 1], MATCH, MISMATCH)
                    elif k == 1 and i + j > 3:
                        gain = np.where(move[i, j - dj] == 1, CODON_EXTEND, cost)
                    found = score[i - di, j - dj] + gain
                    better = found > score[i, j]
                    score[i, j][better] = found[better]
                    move[i, j][better] = k
    out = []
    for p in range(size):
        a, b, i, j = [], [], n, m
        while i or j:
            di, dj, _ = steps[move[i, j, p]]
            a.append(refs[p][i - di : i] or "-" * dj)
            b.append(queries[p][j - dj : j] or "-" * di)
            i, j = i - di, j - dj
        out.append(("".join(a[::-1]), "".join(b[::-1]), float(score[n, m, p])))
    return out


def viterbi(refs: list[str | None], queries: list[str | None]) -> list[tuple[str, str, float]]:
    """Codon-aware global alignments of pairs: whole codons are inserted or deleted cheaply, single
    bases dearly. A null sequence counts as empty; pairs of equal lengths are aligned together."""
    shapes: dict[tuple[int, int], list[int]] = {}
    pairs = [(r or "", q or "") for r, q in zip(refs, queries, strict=True)]
    for p, (r, q) in enumerate(pairs):
        shapes.setdefault((len(r), len(q)), []).append(p)
    out: list = [None] * len(pairs)
    for (n, m), members in shapes.items():
        step = max(1, CELLS // ((n + 1) * (m + 1)))
        for at in range(0, len(members), step):
            some = members[at : at + step]
            for p, found in zip(some, _align_together([pairs[p][0] for p in some], [pairs[p][1] for p in some]), strict=True):
                out[p] = found
    return out


def codon_align(pairs: DataFrame, key: str) -> DataFrame:
    """pairs (key, ref, query) -> (key, ref_aligned, query_aligned, score); no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = viterbi(batch["ref"].to_pylist(), batch["query"].to_pylist())
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64())], [key, "ref_aligned", "query_aligned", "score"])

    kind = pairs.schema[key].dataType.simpleString()
    return pairs.select(key, "ref", "query").mapInArrow(run, f"{key} {kind}, ref_aligned string, query_aligned string, score double")


def _parse(newick: str):
    """Nested (children, name) of a Newick string."""
    stack, children = [], []
    for token in re.findall(r"[(),;]|[^(),;]+", newick):
        if token == "(":
            stack.append(children)
            children = []
        elif token == ")":
            node = [children, ""]
            children = stack.pop()
            children.append(node)
        elif token not in ",;":
            label = token.split(":")[0]
            if children and children[-1][1] == "" and children[-1][0]:
                children[-1][1] = label
            else:
                children.append([[], label])
    return children[0] if children else [[], ""]


def _species(node) -> set[str]:
    return {node[1][:1]} if not node[0] else set().union(*map(_species, node[0]))


def newick_splits(trees: DataFrame) -> DataFrame:
    """trees (tree, newick) -> (tree, n_speciation, n_duplication): inner nodes by their children.

    A node is a speciation if its children's species (first letter of a leaf) are disjoint.
    """

    def count(text: str) -> tuple[int, int]:
        spec = dup = 0
        todo = [_parse(text)]
        while todo:
            node = todo.pop()
            if node[0]:
                sets = [_species(c) for c in node[0]]
                if sum(map(len, sets)) == len(set().union(*sets)):
                    spec += 1
                else:
                    dup += 1
                todo += node[0]
        return spec, dup

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*[count(t) for t in batch["newick"].to_pylist()], strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([batch["tree"], pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32())], ["tree", "n_speciation", "n_duplication"])

    return trees.select("tree", "newick").mapInArrow(run, "tree bigint, n_speciation int, n_duplication int")


def fit_rows(rows: DataFrame, most: int = TASK_ROWS) -> DataFrame:
    """The rows in partitions of about ``most`` at most; few rows stay as they are."""
    need = -(-rows.count() // most)
    return rows.repartition(need) if rows.rdd.getNumPartitions() < need else rows


def train_and_score(features: DataFrame, inputs: list[str], rounds: int = 10, most: int = TASK_ROWS) -> DataFrame:
    """(tx, chain, prob): gradient-boosted trees fitted on clear cases and applied to all rows.

    The fit keeps its rows in memory and reads a partition in a task, so partitions have a bounded number of rows.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    assembler = VectorAssembler(inputCols=inputs, outputCol="x")
    clear = features.filter("exon_cover > 0").select(*inputs, (F.col("pred") >= 50).cast("double").alias("y"))
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=rounds, maxDepth=3, stepSize=0.1, seed=777).fit(assembler.transform(fit_rows(clear, most)))
    return model.transform(assembler.transform(features)).select("tx", "chain", vector_to_array("probability")[1].alias("prob"))
