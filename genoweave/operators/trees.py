"""Gene trees: duplication and speciation labels, pairs that they resolve, and the cliques that such pairs came from."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.operators.graph import connected_components

REFERENCE = ("#R#", "_R_")  # beginnings of the names of reference leaves
# Label of a node by those of its first (row) and second child, both in the order of KINDS.
# R and Q are leaves of reference and query, S a speciation, Dr and Dq duplications in one of the two
# only, D one in both, P what contradicts a speciation.
KINDS = ("D", "P", "S", "Dq", "Dr", "R", "Q")
LABELS = {
    "D": ("D", "D", "D", "D", "D", "D", "D"),
    "P": ("D", "D", "D", "D", "D", "D", "D"),
    "S": ("D", "D", "S", "P", "P", "P", "P"),
    "Dq": ("D", "D", "P", "Dq", "D", "D", "Dq"),
    "Dr": ("D", "D", "P", "D", "Dr", "Dr", "D"),
    "R": ("D", "D", "P", "D", "Dr", "Dr", "S"),
    "Q": ("D", "D", "P", "Dq", "D", "S", "Dq"),
}


class Tree:
    """A Newick tree as arrays of its nodes, children after their parent: parent, name, support, label."""

    def __init__(self, newick: str):
        self.parent: list[int | None] = [None]
        self.name, self.support = [""], [None]
        self.children: list[list[int]] = [[]]
        at = 0
        for token in re.findall(r"\[[^\]]*\]|'[^']*'|[(),;]|:[^(),;\[]*|[^(),;:\[]+", newick):
            if token == ";":
                break
            if token == "(":
                at = self._add(at)
            elif token == ",":
                at = self._add(self.parent[at] or 0)
            elif token == ")":
                at = self.parent[at] or 0
            elif token[0] == "[":
                self._note(at, token[1:-1])
            elif token[0] != ":" and token.strip():
                if self.children[at]:
                    self._note(at, token)
                self.name[at] = token.strip().strip("'")
        self.label = [""] * len(self.parent)
        for i in range(len(self.parent) - 1, -1, -1):
            kids = self.children[i]
            if not kids:
                self.label[i] = "R" if self.name[i].startswith(REFERENCE) else "Q"
            else:  # more than two children meet one after the other, an only one hands its label on
                label = self.label[kids[0]]
                for kid in kids[1:]:
                    label = LABELS[label][KINDS.index(self.label[kid])]
                self.label[i] = label

    def _add(self, parent: int) -> int:
        self.parent.append(parent)
        self.name.append("")
        self.support.append(None)
        self.children.append([])
        self.children[parent].append(len(self.parent) - 1)
        return len(self.parent) - 1

    def _note(self, at: int, text: str) -> None:
        try:
            self.support[at] = float(text)
        except ValueError:
            pass

    def leaves(self) -> list[int]:
        return [i for i, kids in enumerate(self.children) if not kids and len(self.parent) > 1]

    def resolved(self, least: float) -> list[tuple[str, str]]:
        """(reference, query) leaves of the speciations that nothing above them casts doubt on.

        Nodes below the root count: none of them may be a P, none may have a support below ``least``.
        A tree of four leaves in two such pairs also needs every support, the root's too. A query
        transcript (the name up to its last #) in several pairs is not resolved.
        """
        weak = [s is not None and s < least for s in self.support]
        leaves = self.leaves()
        if len(leaves) == 4 and self.label.count("S") == 3 and any(weak):
            return []
        found = []
        for i, kids in enumerate(self.children):
            if i == 0 or self.label[i] != "S" or len(kids) != 2 or any(self.children[k] for k in kids):
                continue
            node, sound = i, not any(weak[k] for k in kids)
            while node and sound:
                sound = self.label[node] != "P" and not weak[node]
                node = self.parent[node]
            if sound:
                a, b = kids if self.label[kids[0]] == "R" else kids[::-1]
                found.append((self.name[a], self.name[b]))
        times = Counter(q.rpartition("#")[0] or q for _, q in found)
        return [(r, q) for r, q in found if times[q.rpartition("#")[0] or q] == 1]


def _per_tree(trees: DataFrame, key: str, rows_of, kinds: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(len(kinds) + 1)]
            for i, newick in enumerate(batch["newick"].to_pylist()):
                for row in rows_of(Tree(newick or "")):
                    for column, x in zip(out, (i, *row), strict=True):
                        column.append(x)
            cols = [pa.array(c, k) for c, (_, k) in zip(out[1:], kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch[key].take(pa.array(out[0], pa.int64())), *cols], [key, *kinds])

    own = trees.schema[key].dataType.simpleString()
    return trees.select(key, "newick").mapInArrow(run, f"{key} {own}, " + ", ".join(f"{n} {k}" for n, (k, _) in kinds.items()))


def label_nodes(trees: DataFrame, key: str) -> DataFrame:
    """trees (key, newick) -> (key, node, parent, name, support, label), the root as node 0.

    Support is a number behind a node's bracket, or in square brackets. Null and empty trees have a
    root alone. A tree is read where it is; nothing is shuffled.
    """
    rows = lambda t: zip(range(len(t.parent)), t.parent, t.name, t.support, t.label, strict=True)
    return _per_tree(trees, key, rows, {"node": ("int", pa.int32()), "parent": ("int", pa.int32()), "name": ("string", pa.string()), "support": ("double", pa.float64()), "label": ("string", pa.string())})


def tree_pairs(trees: DataFrame, key: str, least: float) -> DataFrame:
    """trees (key, newick) -> (key, reference, query): the pairs of leaves that each tree resolves as one to one."""
    return _per_tree(trees, key, lambda t: t.resolved(least), {"reference": ("string", pa.string()), "query": ("string", pa.string())})


def restored_cliques(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """edges (r, q), starts (gene) -> (clique, member): all genes of the cliques that hold a start, by their smallest gene.

    A start without an edge is in no clique. A member has one row, however many starts its clique holds.
    """
    root = connected_components(edges, "r", "q")
    held = root.join(starts.select(F.col("gene").alias("vertex")).distinct(), "vertex", "left_semi").select("root").distinct()
    return root.join(held, "root", "left_semi").select(F.col("root").alias("clique"), F.col("vertex").alias("member"))


def settle_pairs(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """edges (r, q), pairs (reference, query) of genes -> (r, q, settled) of the edges that remain.

    A pair that is an edge settles its two genes: it stays, their other edges go.
    """
    known = pairs.select(F.col("reference").alias("r"), F.col("query").alias("q")).distinct()
    sure = edges.join(known, ["r", "q"], "left_semi").select("r", "q").distinct()
    rest = edges.select("r", "q").distinct().join(sure.select("r"), "r", "left_anti").join(sure.select("q"), "q", "left_anti")
    return sure.withColumn("settled", F.lit(True)).unionByName(rest.withColumn("settled", F.lit(False)))
