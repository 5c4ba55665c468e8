"""License scans: exact set-similarity join of text blocks against templates, plus base phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import LOWER, UPPER, ascii_lower, documents
from genoweave.session import checkpointed, written

THRESHOLD = 0.8  # share of a template's distinct tokens that a block must hold

# Phrases whose words must stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

STRETCH = 8  # longest steps in a stretch of a text, the places of which are compared with each other
BROADCAST_ROWS = 20_000  # rows of the template tables (under 10 KB each) up to which they are broadcast

# Short public notices, or the first sentence of long ones.
TEMPLATES = {
    "mit": "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
    "mit-notice": "Released under the MIT License",
    "apache-2": "Licensed under the Apache License Version 2.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-3": "This work is licensed under the GNU General Public License version 3",
    "gpl-2": "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License version 2",
    "bsd": "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2": "This source code form is subject to the terms of the Mozilla Public License version 2.0",
}

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced(text: Column) -> Column:
    """Lower-cased words, each between single spaces: ' w1 w2 '; a single space if there is none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), _BREAK, " ")), F.lit(" "))


def _words(text: Column) -> Column:
    words = F.trim(text)
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def template_table(spark: SparkSession, templates: dict[str, str], threshold: float = THRESHOLD) -> DataFrame:
    """(label, tokens, step, need): distinct tokens of each template, the step of its blocks and the tokens that a block must hold.

    Blocks are runs of 2 * step words, one begins at every step-th word; step is the template's
    number of words, up to the next power of two. So a copy of the template lies in one block,
    however it is wrapped and wherever it begins.
    """
    rows = spark.createDataFrame(list(templates.items()), "label string, text string").select("label", _words(spaced(F.col("text"))).alias("w"))
    step = F.pow(F.lit(2), F.length(F.bin(F.size("w") - 1))).cast("int")
    sized = rows.filter("size(w) > 0").select("label", F.array_distinct("w").alias("tokens"), F.when(F.size("w") == 1, 1).otherwise(step).alias("step"))
    return sized.withColumn("need", F.ceil(F.size("tokens") * F.lit(threshold) - 1e-9).cast("int"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast what has a row for each template token, if these are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def candidates(parsed: DataFrame, templates: DataFrame, positional: bool = True) -> DataFrame:
    """(rid, label, block, need, n, wanted, has, ..): the blocks that may hold enough of a template.

    parsed: (rid, stretches), where each stretch lists in ``seen`` the places (token, i) of template
    tokens from its first word until two of the longest steps behind its last, so that every block
    lies in the stretch that it begins in, and a place is compared with a stretch, never with the text. Exact:
    tokens are ordered by the number of documents that hold them, the rarest first. A block with
    ``need`` of a template's n tokens shares one of its first n - need + 1 (prefix filter), holds
    ``need`` template tokens (length filter), and after the first shared token both block and
    template have enough tokens left in that order (positional filter).
    """
    tokens = F.array_distinct(F.flatten(F.transform("stretches", lambda x: x["seen"]["token"])))
    counted = parsed.select(F.explode(tokens).alias("token")).groupBy("token").count()
    order = Window.partitionBy("label").orderBy(F.coalesce("count", F.lit(0)), "token")
    ranked = templates.select("label", "step", "need", F.size("tokens").alias("n"), F.explode("tokens").alias("token")).join(counted, "token", "left")
    ranked = ranked.withColumn("p", F.row_number().over(order) - 1).withColumn("key", F.struct(F.coalesce("count", F.lit(0)).alias("f"), F.col("token").alias("t")))
    wanted = ranked.groupBy("label").agg(F.array_sort(F.collect_list("key")).alias("wanted"))
    probe = _small(checkpointed(ranked.filter("p <= n - need").join(wanted, "label").select("label", "step", "need", "n", "token", "wanted")))
    frequency = _small(checkpointed(counted.withColumnRenamed("count", "f")))
    # only what lies near a rare token of a template is looked at
    near = parsed.select("rid", F.explode("stretches").alias("x")).select("rid", "x.start", "x.stop", "x.seen", F.explode("x.seen").alias("e"))
    at = near.select("rid", "start", "stop", "seen", "e.token", "e.i").join(probe, "token")
    first = F.floor(F.col("i") / F.col("step"))
    blocks = at.withColumn("block", F.explode(F.array_distinct(F.array(first, F.greatest(first - 1, F.lit(0))))))
    blocks = blocks.filter((F.col("block") * F.col("step") >= F.col("start")) & (F.col("block") * F.col("step") < F.col("stop")))
    inside = F.filter("seen", lambda x: (x["i"] >= F.col("block") * F.col("step")) & (x["i"] < (F.col("block") + 2) * F.col("step")))
    held = blocks.select("rid", "label", "need", "n", "wanted", "block", F.array_distinct(F.transform(inside, lambda x: x["token"])).alias("tokens"))
    held = held.filter(F.size("tokens") >= F.col("need")).dropDuplicates(["rid", "label", "block"])
    # the tokens of a block in the global order
    keyed = held.select("*", F.explode("tokens").alias("token")).join(frequency, "token")
    grouped = keyed.groupBy("rid", "label", "block").agg(
        F.first("need").alias("need"), F.first("n").alias("n"), F.first("wanted").alias("wanted"), F.array_sort(F.collect_list(F.struct(F.col("f"), F.col("token").alias("t")))).alias("has")
    )
    lowest = F.array_min(F.array_intersect("has", "wanted"))
    left = F.least(F.size(F.filter("has", lambda x: x > F.col("lowest"))), F.size(F.filter("wanted", lambda x: x > F.col("lowest"))))
    passed = grouped.withColumn("lowest", lowest).withColumn("bound", left + 1)
    return passed.filter("bound >= need") if positional else passed


def matching_blocks(parsed: DataFrame, templates: DataFrame) -> DataFrame:
    """(rid, label, block, containment): every block that holds enough of a template, by a full intersection of candidates."""
    checked = candidates(parsed, templates).withColumn("overlap", F.size(F.array_intersect("has", "wanted")))
    return checked.filter("overlap >= need").select("rid", "label", "block", (F.col("overlap") / F.col("n")).alias("containment"))


def parse(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, own, n_words, p0 .., stretches), in one scan: number of words, places of each phrase, places of template tokens.

    The result is a written table, a row for each row of ``docs``; rid numbers them. Places come in
    stretches (start, stop, seen) of ``STRETCH`` times the longest step, see ``candidates``.
    """
    known = templates.select("tokens", "step").collect()
    vocabulary = sorted({t for r in known for t in r["tokens"]})
    widest = max((r["step"] for r in known), default=1)
    size = STRETCH * widest
    rows = docs.select(F.col(id_col).alias("own"), spaced(F.coalesce(F.col(text_col), F.lit(""))).alias("s"))
    none = F.array().cast("array<int>")

    def places(phrase: str) -> Column:
        parts = phrase.split(" ")
        at = F.sequence(F.lit(1), F.size("w") - len(parts) + 1)
        here = lambda i: F.forall(F.array(*[F.element_at("w", i + j) == p for j, p in enumerate(parts)]), lambda x: x)
        return F.when(F.contains("s", F.lit(f" {phrase} ")), F.filter(at, here)).otherwise(none)

    def stretch(k: Column) -> Column:
        words = F.slice("w", k * size + 1, F.lit(size + 2 * widest))
        places_of = F.transform(words, lambda x, i: F.struct(x.alias("token"), (k * size + i).alias("i")))
        seen = F.filter(places_of, lambda x: x["token"].isin(vocabulary) if vocabulary else F.lit(False))
        return F.struct((k * size).alias("start"), ((k + 1) * size).alias("stop"), seen.alias("seen"))

    last = F.greatest(F.ceil(F.size("w") / size).cast("int") - 1, F.lit(0))
    stretches = F.filter(F.transform(F.sequence(F.lit(0), last), stretch), lambda x: F.size(x["seen"]) > 0)
    out = rows.select("own", "s", _words(F.col("s")).alias("w")).select(
        F.monotonically_increasing_id().alias("rid"), "own", F.size("w").cast("bigint").alias("n_words"), *[places(p).alias(f"p{i}") for i, p in enumerate(PHRASES)], stretches.alias("stretches")
    )
    return written(out, "license-words")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Labels of every document: base phrases and matching blocks.

    Returns id, n_words, n_base, first_word, last_word (null without a base phrase), base_labels,
    labels (sorted, comma-joined; empty without any) and score: 1 with a base phrase, else the
    largest containment of a matching block, else 0. Null texts are empty. Every row is judged by
    its own text, repeated rows and rows that share or lack an id too; other columns are ignored; no
    rows give no rows.
    """
    known = template_table(docs.sparkSession, TEMPLATES if templates is None else templates, threshold)
    parsed = parse(docs, known, id_col, text_col)
    at = F.concat(*[f"p{i}" for i in range(len(PHRASES))])
    base = parsed.select(
        "rid",
        F.col("own"),
        "n_words",
        F.size(at).cast("bigint").alias("n_base"),
        (F.array_min(at) - 1).cast("bigint").alias("first_word"),
        (F.array_max(at) - 1).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())])))).alias("base"),
    )
    found = matching_blocks(parsed.select("rid", "stretches"), known)
    found = found.groupBy("rid").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    return base.join(found, "rid", "left").select(
        F.col("own").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _sql() -> str:
    words = lambda x: f"regexp_extract_all(translate({x}, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    phrases = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"('{label}', '{t}')" for label, t in TEMPLATES.items())
    return f"""
WITH d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
phrases(phrase, n, label) AS (VALUES {phrases}),
wanted AS (SELECT label, {words("t")} AS w FROM (VALUES {templates}) x(label, t)),
places AS (SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d) e, phrases WHERE w[i + 1] = split_part(phrase, ' ', 1) AND array_to_string(w[i + 1:i + n], ' ') = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS b FROM places GROUP BY doc_id),
sized AS (SELECT label, list_distinct(w) AS t, CAST(pow(2, ceil(log2(len(w)))) AS BIGINT) AS step FROM wanted),
tokens AS (SELECT label, step, len(t) AS n, unnest(t) AS token FROM sized),
seen AS (SELECT doc_id, w[i + 1] AS token, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d) x),
placed AS (SELECT doc_id, label, n, token, unnest([i // step, i // step - 1]) AS block FROM seen JOIN tokens USING (token)),
hits AS (SELECT doc_id, label, count(DISTINCT token) / n AS c FROM placed WHERE block >= 0 GROUP BY doc_id, label, n, block HAVING count(DISTINCT token) >= {THRESHOLD} * n - 1e-9),
best AS (SELECT doc_id, list(DISTINCT label) AS m, max(c) AS c FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(coalesce(b, []), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(coalesce(b, []), coalesce(m, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
"""


SQL = _sql()
