from helpers import edge_docs, no_docs, prose
from pyspark.sql import functions as F

from herald.llm import license_scan as L
from herald.llm.license_texts import full_texts


def scan(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    return {r.doc_id: r for r in L.license_scan(df, "doc_id", F.col("path"), **options).collect()}


def test_headers_files_and_nearest_ancestor(spark):
    mit, gpl = L.TEMPLATES["MIT"][1], "# " + L.TEMPLATES["GPL-3.0"][1]
    got = scan(spark, [
        (1, "LICENSE", mit), (2, "a/LICENSE", gpl), (3, "a/b/c/x.py", prose(50)), (4, "d/x.py", prose(50, 1)),
        (5, "a/y.py", prose(80, 2) + "\n// Licensed under the Apache License, Version 2.0\n" + prose(30)),
        (6, "top.txt", None), (7, "a/b/LICENSE", prose(40, 3)), (8, "ab/x.py", ""), (9, None, prose(9))])
    kinds = {i: (r.license, r.how, r.from_dir) for i, r in got.items()}
    assert kinds == {1: ("MIT", "header", None), 2: ("GPL-3.0", "header", None), 3: ("GPL-3.0", "inherited", "a"),
                     4: ("MIT", "inherited", ""), 5: ("Apache-2.0", "header", None), 6: ("MIT", "inherited", ""),
                     7: ("GPL-3.0", "inherited", "a"), 8: ("MIT", "inherited", ""), 9: ("MIT", "inherited", "")}
    assert got[1].licence_file and got[2].licence_file and not got[5].licence_file
    assert got[5].line == 1 and got[5].score > 0.8


def test_every_template_names_itself(spark):
    rows = [(i, f"{i}/x", t) for i, (n, t) in enumerate((n, t) for n, ts in L.TEMPLATES.items() for t in ts)]
    got = scan(spark, rows)
    names = [n for n, ts in L.TEMPLATES.items() for _ in ts]
    assert [got[i].license for i in range(len(rows))] == names


def test_stop_words_alone_stay_below_the_threshold(spark):
    """The pattern that admits lines loses no match: stop words make at most the threshold of any template."""
    stop = " ".join(sorted(L.STOP_WORDS))
    rows = [(0, "x/y", prose(30) + "\n" + stop)] + [(i + 1, f"{i}", prose(20, i)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    weights, _ = L.term_weights(spark, df, "text")
    idf = {r.term: r.idf for r in weights.collect()}
    vectors = {}
    for name, term, n in L.template_terms():
        vectors.setdefault(name, {})[term] = n * idf[term]
    for v in vectors.values():
        norm = sum(x * x for x in v.values())
        common = sum(x * x for t, x in v.items() if t in L.STOP_WORDS)
        assert (common / norm) ** 0.5 < 0.85
    assert scan(spark, rows)[0].license is None


def test_copies_and_awkward_rows(spark):
    text = "All rights reserved.\n" + prose(40)
    got = scan(spark, [(i, f"d{i}/x", text) for i in range(5)])
    assert {(r.license, r.licence_file, r.score) for r in got.values()} == \
        {("LicenseRef-all-rights-reserved", False, 1.0)}
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    assert L.license_scan(edge_docs(spark), "doc_id", path).count() == 15
    assert L.license_scan(no_docs(spark), "doc_id", path).count() == 0


def test_plan_has_no_python(spark):
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    plan = L.license_scan(edge_docs(spark), "doc_id", path)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_whole_licence_texts_speak_for_their_directories(spark):
    """Each with a copyright line of its own; wrapped as its file has it, and as one line."""
    texts = full_texts()
    rows = [(i, f"{n}/LICENSE", f"Copyright (c) 2019 {prose(5, i)}\n\n{t}") for i, (n, t) in enumerate(texts.items())]
    rows += [(i + 100, f"{n}/src/x.py", prose(30, i)) for i, n in enumerate(texts)]
    rows += [(i + 200, f"flat/{n}/COPYING", " ".join(t.split())) for i, (n, t) in enumerate(texts.items())]
    rows += [(i + 300, f"p{i}/x", prose(90, i)) for i in range(60)]
    got = scan(spark, rows)
    for i, n in enumerate(texts):
        assert (got[i].license, got[i].licence_file, got[i].line) == (n, True, None)
        assert got[i].score > 0.9
        assert (got[i + 100].license, got[i + 100].how, got[i + 100].from_dir) == (n, "inherited", n)
        assert (got[i + 200].license, got[i + 200].licence_file) == (n, True)
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "AGPL-3.0"} <= set(texts)


def test_candidates_lose_no_whole_text(spark):
    """The distinct words that admit a text rule out no cosine from the threshold on, also in a cut text."""
    texts = full_texts()
    cut = [(n, " ".join(t.split()[:len(t.split()) * k // 10])) for n, t in texts.items() for k in range(3, 11)]
    other = [(1000 + i, prose(300, i) + " the software is provided as is") for i in range(50)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cut)] + other, "key long, text string")
    docs = df.select("text").union(spark.createDataFrame(
        [(prose(60, i) + " the software is provided as is to you and of a in or any this for by",)
         for i in range(3000)], "text string"))
    weights, unseen = L.term_weights(spark, docs, "text")
    idf = {r.term: r.idf for r in weights.collect()}
    toks = df.select("key", L.tokens(F.col("text")).alias("toks"))
    admitted = {r.key for r in toks.filter(L.may_be_full("array_distinct(toks)", idf, 0.8)).collect()}
    matched = {r.key for r in L.full_matches(toks, weights, unseen, 0.8).collect()}
    assert len(matched) >= 2 * len(texts) and matched <= admitted <= set(range(len(cut)))


def test_notices_inside_paragraphs_and_over_line_ends(spark):
    gnu = ("# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU {}"
           "General Public License as\n# published by the Free Software Foundation; either version {}\n# of the "
           "License, or (at your option) any later version.\n")
    cases = [
        ("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
        ("GPL-2.0", "distributed under the GNU General Public License, version 2"), ("GPL-2.0", gnu.format("", 2)),
        ("GPL-3.0", gnu.format("", 3)), ("LGPL-2.1", gnu.format("Lesser ", 2.1)), ("AGPL-3.0", gnu.format("Affero ", 3)),
        ("GPL-1.0-or-later", "It is covered by the GNU General Public License."),
        ("CC-BY-ND-4.0", "This work is licensed under CC BY-ND 4.0."),
        ("CC-BY-3.0", "under a Creative Commons Attribution 3.0 Unported License"),
        ("CC0-1.0", "Licensed under CC0 1.0 Universal"), ("BSD-2-Clause", "see the BSD 2-Clause License"),
        ("ISC", "and is licensed under the ISC License"), ("LicenseRef-all-rights-reserved", "All rights reserved."),
        ("Apache-2.0", "All rights reserved. Licensed under the Apache License, Version 2.0"),
        ("MIT", "SPDX-License-Identifier: mit"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
        ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
        ("MIT OR Apache-2.0", "/* SPDX-License-Identifier: (MIT OR Apache-2.0) */"),
        (None, "It is released under the license of its owner, mit allen Rechten."), (None, "the MIT campus")]
    rows = [(i, f"{i}/x", f"{prose(12, i)} {t} {prose(12, i + 1)}") for i, (_, t) in enumerate(cases)]
    rows += [(i + 100, f"a{i}/x", t) for i, (_, t) in enumerate(cases)]
    rows += [(i + 200, f"p{i}/x", prose(90, i)) for i in range(60)]
    got = scan(spark, rows)
    assert [got[i].license for i in range(len(cases))] == [n for n, _ in cases]
    assert [got[i + 100].license for i in range(len(cases))] == [n for n, _ in cases]
