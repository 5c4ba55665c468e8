"""Notices that are wrapped, commented or embedded, and the filters of the set join."""

import random
import textwrap
import time

import pytest

from genoweave.llm import licenses

# The opening lines of published notices.
NOTICES = {
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use',
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "gpl-2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def labels(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["labels"].split(",") for r in licenses.scan_licenses(docs, **more).orderBy("doc_id").collect()]


@pytest.mark.parametrize("width", [40, 72, 1000])
def test_wrapped_notices_are_found(spark, width):
    prose = "Plain words come before and after, on lines of their own. " * 7
    texts = []
    for i, notice in enumerate(NOTICES.values()):
        lines = textwrap.wrap(notice, width)
        texts += ["\n".join(lines), prose + "\n" + "\n".join(f" * {x}" for x in lines) + "\n" + prose[: 100 * i]]
    got = labels(spark, texts)
    for i, label in enumerate(NOTICES):
        assert label in got[2 * i] and label in got[2 * i + 1], (label, got)
    assert labels(spark, [prose, None, ""]) == [[""], [""], [""]]


def test_scattered_words_are_no_notice(spark):
    words = licenses.TEMPLATES["bsd"].split()
    assert labels(spark, [(" padding" * 9 + " ").join(words)]) == [[""]]


def test_positional_filter_prunes_and_loses_nothing(spark):
    templates = licenses.template_table(spark, {"a": "r1 r2 c1 c2 c3", "b": "r3 c1 c2 c3 c4"}, 0.8)
    texts = ["r1 r2 c1 c2 c3", "r2 x y z", "r2 r3 c4 c1", "c1 c2 c3 c4"] + ["c1 c2"] * 30 + ["c3 c4"] * 20 + ["r1 r3 c4 r2"] * 3 + ["c1 c2 r1 r3 q"] + ["c4 c1 c3 r3 z", "c2 c3 r1 c1 r3 c4"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parsed = licenses.parse(docs, templates)
    every = licenses.candidates(parsed, templates, positional=False).collect()
    kept = {(r["rid"], r["label"], r["block"]) for r in licenses.candidates(parsed, templates).collect()}
    right = {(r["rid"], r["label"], r["block"]) for r in every if len(set(r["has"]) & set(r["wanted"])) >= r["need"]}
    assert right and right <= kept and len(kept) < len(every)


def test_many_templates_need_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    many = {f"l{i}": f"n{i} of m{i} and k{i} too" for i in range(300)}
    assert labels(spark, ["so n7 of m7\nand k7 too", "nothing"], templates=many) == [["l7"], [""]]


def test_long_texts_of_template_words(spark):
    """Work grows with the words: a text of 30,000 template words, each near hundreds of others, and a notice at its end."""
    rng = random.Random(4)
    words = sorted({w for t in licenses.TEMPLATES.values() for w in t.split()})
    dense = [" ".join(rng.choice(words) for _ in range(n)) for n in (2_000, 30_000)]
    took = []
    for text in dense:
        began = time.time()
        got = labels(spark, [text + " . " + licenses.TEMPLATES["bsd"]])
        took.append(time.time() - began)
        assert "bsd" in got[0]
    assert took[1] < 15 * took[0] + 30
    # whatever stretch a notice begins in, and wherever in it
    lone = [" ".join(["filler"] * n) + " " + licenses.TEMPLATES["gpl-2"] for n in (0, 1, 31, 32, 200, 223, 224, 225, 255, 256, 257, 511)]
    assert all(x == ["gpl-2"] for x in labels(spark, lone))
