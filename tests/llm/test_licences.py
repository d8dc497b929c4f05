import random
import re

import pytest

from pyspark.sql import functions as F

from fleetpulse.llm import licences
from tests.llm import cases

SF = "/root/testdata/sf0.01"
# What the licence lines of the test documents say, written down independently of the templates.
SAYS = {
    "apache": "Apache License, Version 2.0", "cc-by-nc": "CC BY-NC 4.0",
    "gpl": "GNU General Public License, version 3", "mit": "MIT License",
}


@pytest.fixture(scope="module")
def scanned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [
            (2001, "intro line\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\nend"),
            (2002, "The licence of the driver was taken away by the public servant."),
            (2003, "SPDX-License-Identifier: MIT\nLicensed under the Apache License, Version 2.0."),
            (2004, "licensed UNDER the mit LICENSE - see the file for details"),
            (2004, "licensed UNDER the mit LICENSE - see the file for details"),
            (None, "Released under the MIT License."),
            (2005, None),
            (2006, ""),
            (2007, "\n\n"),
            (2008, cases.prose(1, 30_000)),
        ],
        "doc_id bigint, text string",
    )
    docs = docs.select("doc_id", "text").unionByName(extra)
    for name in cases.CLASHING:
        docs = docs.selectExpr("*", f"'own' AS {name}")
    return docs.select("doc_id", "text").collect(), licences.scan(docs).collect()


def test_finds_the_notices_and_no_others(scanned):
    docs, found = scanned
    assert len(found) == len(docs)
    families = {r["doc_id"]: r["families"] for r in found}
    for doc, text in docs:
        if doc is not None and doc < 2000:
            assert families[doc] == ",".join(f for f in sorted(SAYS) if SAYS[f] in (text or ""))


def test_edge_rows(scanned):
    found = {}
    for r in scanned[1]:
        found.setdefault(r["doc_id"], []).append((r["n_paragraphs"], r["n_notices"], r["families"]))
    assert found[2001] == [(3, 1, "mpl")] and found[2003] == [(2, 2, "apache,mit")]
    assert found[2002] == [(1, 0, "")] and found[2004] == [(1, 1, "mit")] * 2
    assert found[None] == [(1, 1, "mit")]
    assert found[2005] == found[2006] == found[2007] == [(0, 0, "")] and found[2008] == [(1, 0, "")]


def test_no_documents(spark):
    assert licences.scan(cases.empty(spark)).collect() == []


def test_only_the_jvm_works(spark):
    lines = licences.paragraphs(cases.edge(spark))
    plan = licences.featurize(lines)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
AGPL = GPL.replace("GNU General Public License as", "GNU Affero General Public License\nas")


def commented(text, mark):
    return "\n".join(mark + line for line in text.split("\n"))


def test_notices_wrapped_over_lines(spark):
    torn = MIT.replace("obtaining a copy\n", "obtaining a copy\n\n\n")
    long = " ".join(f"w{i}" for i in range(500))
    cases_ = {
        1: (MIT, 1, "mit"),
        2: (commented(BSD, " * "), 1, "bsd"),
        3: ("intro words\n" + commented(GPL, "# ") + "\nint main() {}", 1, "gpl"),
        4: (LGPL, 1, "lgpl"),
        5: (AGPL, 1, "agpl"),
        6: (MIT + "\n" + BSD, 2, "bsd,mit"),
        7: ("Copyright\n\n" + MIT + "\n\n" + MIT.replace("\n", "\r\n"), 2, "mit"),
        8: ("Released under the MIT License.\n" + commented(GPL, "// "), 2, "gpl,mit"),
        9: (torn, 0, ""),
        10: (f"{long} {MIT} {long}".replace("\n", "\n// "), 1, "mit"),
        11: ("\n".join(MIT.split()[:24]), 1, "mit"),
        12: ("The software was granted to a person\nfree of charge and the conditions\nwere met", 0, ""),
    }
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 5000 AS doc_id", "text")
    extra = spark.createDataFrame([(k, v[0]) for k, v in cases_.items()], "doc_id bigint, text string")
    found = licences.scan(docs.unionByName(extra)).where("doc_id < 100").collect()
    got = {r["doc_id"]: (r["n_notices"], r["families"]) for r in found}
    assert got == {k: v[1:] for k, v in cases_.items()}
    assert {r["unconfirmed"] for r in found if r["doc_id"] in (1, 6, 7)} == {0}


def test_every_confirmed_text_has_an_anchor():
    # Leaving all anchors out of a template leaves too little of it.
    told = set(licences.anchors())
    for text in {t for texts in licences.TEMPLATES.values() for t in texts}:
        listed = licences._plain_words(text)
        grams = {(w,) for w in listed} | set(zip(listed, listed[1:]))
        assert sum(not told & set(g) for g in grams) < licences.CONFIRM * len(grams)


def plain_words(text):
    runs = re.split(r"[^a-z0-9+-]+", text.lower())
    return [w for w in (re.sub(r"^[-+]+|-+$", "", r) for r in runs) if w]


def plain_windows(text):
    lines = [plain_words(re.sub(r"^\s*(?:rem|REM|dnl)\s", " ", x)) for x in text.split("\n")]
    telling, out = set(licences.anchors()), set()
    for at, first in enumerate(lines):
        made = first[-licences.SPAN :] if first else []
        n, last = 0, at
        while first and last + 1 < len(lines) and n < licences.SPAN and lines[last + 1]:
            last += 1
            head = lines[last][: licences.SPAN]
            made, n = made + head, n + len(head)
            if telling & set(made):
                out.add((at, last, " ".join(made)))
    return out


def test_windows_equal_plain_version(spark):
    rng = random.Random(5)
    vocabulary = [*licences.anchors()[:8], *"a the of +x -y c++ -- b- non-x +".split(), *"qwertzuiop"]
    texts = ["\n".join(" ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 9, 80)))) for _ in range(40)) for _ in range(6)]
    texts += ["\n".join(rng.choice(("x y", "z")) for _ in range(90)) + "\nlicensed\n" + "u v\n" * 90]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = docs.select(licences.text_key().alias("key"), "text").distinct().collect()
    names = {bytes(r["key"]): r["text"] for r in found}
    made = {}
    for r in licences.windows(docs).collect():
        made.setdefault(names[bytes(r["key"])], set()).add((r["at"], r["last"], r["text"]))
    assert made == {t: w for t in texts if (w := plain_windows(t))}


def test_words_at_their_edges(spark):
    texts = ["c++ -a- +b+ --- a-b- -+-c-+- x+-", "", "+", "A_b C-", "- - d --e"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", licences.words(F.col("t")).alias("w"))
    assert {r["t"]: r["w"] for r in rows.collect()} == {t: plain_words(t) for t in texts}


def test_windows_of_a_very_long_text(spark):
    """A hundred thousand lines, three of them telling: work follows the lines."""
    lines = [cases.prose(i % 50, 6) for i in range(100_000)]
    for at in (5, 50_000, 99_990):
        lines[at] = "Licensed under the MIT"
        lines[at + 1] = "License."
    docs = spark.createDataFrame([("\n".join(lines),)], "text string")
    assert {5, 50_000, 99_990} <= {r["at"] for r in licences.windows(docs).collect()}


def test_the_weights_are_bounded_and_know_the_templates(spark):
    """The driver trains on vectors of families times grams: large ones fill its memory."""
    lines = [(cases.prose(i, 40),) for i in range(300)]
    paragraphs = spark.createDataFrame(lines, "text string")
    model = licences.train(paragraphs).model
    weights = model.stages[-1].coefficientMatrix
    assert weights.numCols <= licences.VOCABULARY and weights.numRows * weights.numCols * 8 < 1 << 19
    own = {g for r in licences.templates(spark).collect() for g in r["grams"]}
    assert own <= set(model.stages[0].vocabulary)
