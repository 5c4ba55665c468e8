"""Items that share or lack an id, and both ways to reach the signatures."""

import random

import pytest

from genoweave.llm import decontaminate


def planted(spark, item_id):
    """300 items with ids by ``item_id``, each planted with a tenth of its words changed at one end."""
    r = random.Random(3)
    items = [[f"w{r.randrange(10**6)}" for _ in range(r.randrange(20, 60))] for _ in range(300)]
    docs = []
    for i, words in enumerate(items):
        body = words[len(words) // 10 :]
        docs.append((i, " ".join([f"x{r.randrange(10**6)}" for _ in range(r.randrange(200))] + body + ["tail"] * 9)))
    table = spark.createDataFrame([(item_id(i), " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    return spark.createDataFrame(docs, "doc_id long, text string"), table


@pytest.mark.parametrize("rows", [400_000, 0])
@pytest.mark.parametrize("ids", ["own", "shared", "none"])
def test_no_planted_item_is_lost(spark, monkeypatch, ids, rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
    docs, items = planted(spark, {"own": lambda i: i, "shared": lambda i: i % 7, "none": lambda i: None}[ids])
    found = decontaminate.contaminated(docs, items).collect()
    assert {r["doc_id"] for r in found} == set(range(300))
    assert all(r["item_id"] == {"own": r["doc_id"], "shared": r["doc_id"] % 7, "none": None}[ids] for r in found)
    assert all(r["containment"] >= 0.8 for r in found)


def test_many_candidates_of_a_document(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 8)
    docs, items = planted(spark, lambda i: i)
    whole = " ".join(r["text"] for r in docs.orderBy("doc_id").collect())
    one = spark.createDataFrame([(None, whole), (None, None)], "doc_id long, text string")
    assert sorted(r["item_id"] for r in decontaminate.contaminated(one, items).collect()) == list(range(300))
