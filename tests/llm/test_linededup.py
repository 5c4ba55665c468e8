"""Runs of line hashes meet batches and each other without a shuffle of a run."""

import random
import re
import time

from pyspark.sql import functions as F

from genoweave.llm.linededup import LineRuns, drop_repeated_lines
from genoweave.session import partitions


def _batch(spark, low, high):
    rows = spark.range(low, high).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"), "id")
    return rows.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("keep"))


def test_runs_are_not_shuffled(spark):
    runs = LineRuns(spark, partitions(spark))
    seen = []
    write = runs._write
    runs._write = lambda keys, level: (seen.append(keys._jdf.queryExecution().executedPlan().toString()), write(keys, level))
    for low in (0, 500, 1000, 1500):
        runs.add(_batch(spark, low, low + 1000))
    for plan in seen:
        scans = len(re.findall(r"FileScan parquet \S*line_run", plan))
        assert plan.count("Exchange hashpartitioning") == plan.count("Range ("), plan
        assert plan.count("Bucketed: true") == scans, plan
    total = runs.totals().agg(F.count("*"), F.sum("n_docs"), F.max("n_docs")).first()
    assert tuple(total) == (2500, 4000, 2)
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    left = {t.name for t in spark.catalog.listTables()}
    assert runs.levels[2][0] in left


def test_texts_of_many_lines(spark):
    """Every kept line is right, and twice the lines take about twice the time, where all of them are lost."""
    rng = random.Random(1)
    took = {}
    for n in (8_000, 32_000):
        lines = [f"this line has number {i} of {n} lines" for i in range(n)]
        docs = [(i, "\n".join(lines)) for i in (1, 2, 3)]
        mixed = [f"only here {i} {rng.random()}" if i % 3 else lines[i] for i in range(n)] + ["short"] * 3 + [lines[5], lines[5]]
        docs.append((0, "\n".join(mixed)))
        began = time.time()
        rows = {r["doc_id"]: r for r in drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        took[n] = time.time() - began
        assert rows[3]["n_dropped"] == 0 and rows[1]["n_dropped"] == rows[2]["n_dropped"] == n and rows[1]["kept_text"] == ""
        gone = set(lines)
        assert rows[0]["kept_text"] == "\n".join(x for x in mixed if x not in gone)
    assert took[32_000] < 6 * took[8_000] + 10
