"""The rounds of the block operators leave no tables behind and move numbers, not names."""

import os

from genoweave.operators import blocks
from genoweave.session import shared_dir


def test_rounds_are_discarded(spark):
    path = shared_dir(spark)
    before = set(os.listdir(path)) if os.path.exists(path) else set()
    edges = [(f"v{i:03}", f"v{i + 1:03}") for i in range(60)] + [("v000", "v010"), ("v020", "v040"), ("x", "y")]
    found = blocks.articulation_points(spark.createDataFrame(edges, "a string, b string"))
    assert {r["vertex"] for r in found.collect()} == {f"v{i:03}" for i in (*range(10, 21), *range(40, 60))}
    left = [p.rsplit("-", 1)[0] for p in set(os.listdir(path)) - before]
    assert left.count("tour") == 0 and left.count("edges") == 1 and left.count("edges-left") <= 1
    assert dict(blocks._numbered(blocks._plain(spark.createDataFrame(edges, "a string, b string"), "a", "b"))[0].dtypes) == {"a": "bigint", "b": "bigint"}
