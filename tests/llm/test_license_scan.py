import random
import re

import pytest

from stratamart.llm import license_scan as S


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates):
    own = words(text)
    places = {label: [i for i in range(len(own)) if own[i:i + len(p.split())] == p.split()] for p, label in S.PHRASES.items()}
    every = sorted(i for at in places.values() for i in at)
    base = {label for label, at in places.items() if at}
    found = {}
    for t in templates:
        wanted, width, needed = set(t.words), t.width, t.needed
        for i in range(len(own) if len(wanted & set(own)) >= needed else 0):
            block = own[i:i + width]
            share = len(wanted.intersection(block)) / len(wanted)
            if len(wanted.intersection(block)) >= needed and all(f" {m} " in f" {' '.join(block)} " for m in t.must):
                found[t.label] = max(share, found.get(t.label, 0))
    score = 1.0 if base else max(found.values(), default=0.0)
    return (len(own), len(every), every[0] if every else None, every[-1] if every else None,
            ",".join(sorted(base)), ",".join(sorted(base | set(found))), score)


def texts():
    dice = random.Random(1)
    out = [None, "", " \n\n", "MIT License", "mit license mit license", "cc by cc by cc by", "CC-BY 4.0", "cc\nby", "GNU GPL",
           "GNU General Public License!! gnu general public license", "x" * 50000, "é mit license ß", "mit licenses", "submit license",
           "Apache\u00a0License", "apache license " * 3000, "cc by nc", "mİt license"]
    notices = [t.text for t in S.TEMPLATES]
    for _ in range(150):
        parts = []
        for _ in range(dice.randint(1, 8)):
            w = dice.choice(notices).split()
            for _ in range(dice.randint(0, 4)):
                w[dice.randrange(len(w))] = dice.choice(["zzz", "the", "License", "of"])
            if dice.random() < 0.5:
                dice.shuffle(w)
            parts.append(" ".join(w[:dice.randint(1, len(w))] if dice.random() < 0.3 else w + ["more"] * dice.randint(0, 6)))
        out.append(dice.choice(["\n", " ", "\r\n"]).join(parts))
    return out


def test_equals_brute_force(spark):
    rows = [(i, t, "x", i % 3) for i, t in enumerate(texts())] + [(None, "MIT License", "y", 0)] * 2 + [(3, "other", "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score int").repartition(4)
    out = S.scan(docs, ["doc_id"])
    assert out.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted(((d, *brute(t, S.TEMPLATES)) for d, t, _, _ in rows), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want


@pytest.mark.parametrize("seed", range(3))
def test_every_order_finds_the_same(spark, seed):
    """The global order changes candidates, never results."""
    dice = random.Random(seed)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    vocabulary = sorted({w for t in S.TEMPLATES for w in t.words})
    index = S.TemplateIndex.build(S.TEMPLATES, {w: dice.randint(0, 9) for w in vocabulary})
    got = {r.doc_id: tuple(r)[1:] for r in S.scan(docs, ["doc_id"], index=index).collect()}
    assert got == {i: brute(text, S.TEMPLATES) for i, text in enumerate(texts())}


def test_no_python_and_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.scan(docs, ["doc_id"]).count() == 0
    out = S.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), ["doc_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    want = sorted((r.doc_id, *brute(r.text, S.TEMPLATES)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert sorted(map(tuple, S.op10_license_scan(spark, folder).collect())) == want


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files, to deal"""
ISC = """ * Permission to use, copy, modify, and/or distribute this software for any
 * purpose with or without fee is hereby granted, provided that the above"""


CASES = [
    (BSD, ["bsd"]), (MIT, ["mit-grant"]), (ISC, ["isc-grant"]), ("x y\n" * 50 + BSD + "\r\n\r\n" + MIT, ["bsd", "mit-grant"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3.0"]),
    ("licensed under the GNU General\nPublic License, version 2", ["gpl-2.0"]),
    ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
     "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.", ["gpl-3.0"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.", ["mpl-2.0"]),
    ("licensed under the GNU Lesser General Public License, version 3", ["lgpl"]),
    ("licensed under the GNU Affero General Public License, version 3", ["agpl-3.0"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]), ("Licensed under CC BY-SA 4.0", ["cc-by-sa-4.0"]), ("Licensed under CC BY 4.0", ["cc-by-4.0"]),
    ("Released under the BSD License", []), ("Released under the MIT License", ["mit-notice"]),
    ("released " + "word " * 40 + "under " + "word " * 40 + "the license " + "word " * 40 + "mit", []),
    ("", []), (None, []),
]


def test_one_notice_one_label(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "doc_id long, text string")
    got = {}
    for r in S.notices(docs, ["doc_id"]).collect():
        got.setdefault(r.doc_id, []).append(r.template)
    assert {i: sorted(labels) for i, labels in got.items()} == {i: want for i, (_, want) in enumerate(CASES) if want}


def test_every_template_is_its_own_notice(spark):
    docs = spark.createDataFrame([(t.label, t.text) for t in S.TEMPLATES], "doc_id string, text string")
    assert sorted(map(tuple, S.notices(docs, ["doc_id"]).collect())) == sorted((t.label, t.label, 1.0) for t in S.TEMPLATES)
