"""License scans: sparse TF-IDF cosine to license templates, then directory inheritance.

Every line of every text is a possible license header. Lines that hold a telling
word of a template become sparse TF-IDF vectors, with document frequencies counted
over all texts, and meet the templates by their terms; the best cosine from
``THRESHOLD`` on names the file's license. Windows of a template's length, aligned at a telling word of the
text's token stream, do the same within longer lines and across line ends, and SPDX identifiers name
theirs. A match must hold the names and versions of its template. Every text also meets the whole licence texts as
one vector; a cosine from ``FILE_THRESHOLD`` on names the license before any line does. Such a file,
or one most of whose words lie in license lines, is a licence file and speaks for its directory. A file without a license of its own
inherits that of its nearest ancestor directory, found by joining paths. DataFrame
functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from herald.llm.common import Scratch
from herald.llm.license_texts import full_texts

THRESHOLD = 0.6
#: Whole texts of different license families reach 0.75 with each other, documents of other kinds 0.3.
FILE_THRESHOLD = 0.8
#: Below this idf a word is taken to be in every text (only for choosing candidates).
COMMON_IDF = 2.0
HEAVIEST = 40
FILE_SHARE = 0.25
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"

# Short notices and opening sentences by SPDX license identifier ("LicenseRef-" where
# there is none).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0; you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    "BSD-3-Clause": ("Released under the 3-Clause BSD License.",
                     "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or any later version."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "LicenseRef-all-rights-reserved": ("All rights reserved.",
                                       "Copyright. All rights reserved."),
}
# Words too common to point to a license by themselves.
STOP_WORDS = frozenset("a all and any are as at be by can either except following for form free from in into is it "
                       "later may met not obtain of on or or person provided public source subject that the this "
                       "to under use version with without work you".split())


def template_terms() -> list[tuple[str, str, int]]:
    """(template, term, count); a template is called ``license#number``."""
    return [(f"{name}#{i}", term, n) for name, texts in TEMPLATES.items() for i, t in enumerate(texts)
            for term, n in sorted(Counter(re.findall(TOKEN, t.lower())).items())]


def _notices() -> dict[str, tuple[str, ...]]:
    found = {
        "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License",
                       "Licensed under Apache 2.0", "Licensed under Apache-2.0", "Apache-2.0 License"),
        "MIT": ("MIT License", "MIT licensed", "Licensed under MIT", "under the MIT License"),
        "ISC": ("ISC License", "Licensed under ISC",
                "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                "fee is hereby granted"),
        "BSD-2-Clause": ("2-Clause BSD License", "BSD 2-Clause License", "Simplified BSD License",
                         "Licensed under BSD-2-Clause"),
        "BSD-3-Clause": ("3-Clause BSD License", "BSD 3-Clause License", "New BSD License", "Modified BSD License",
                         "Licensed under BSD-3-Clause"),
        "0BSD": ("Zero-Clause BSD License", "Licensed under 0BSD"),
        "CC0-1.0": ("CC0 1.0 Universal", "Licensed under CC0", "Licensed under CC0 1.0", "CC0 License",
                    "Creative Commons CC0"),
        "Unlicense": ("Released under the Unlicense",),
        "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "Licensed under MPL 1.1"),
        "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0",
                    "Mozilla Public License 2.0", "Licensed under MPL 2.0", "Licensed under MPL-2.0"),
        "EPL-1.0": ("Eclipse Public License v1.0", "Eclipse Public License 1.0"),
        "EPL-2.0": ("Eclipse Public License v2.0", "Eclipse Public License 2.0"),
        "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
        "Artistic-2.0": ("Artistic License 2.0", "Artistic License, Version 2.0"),
        "Zlib": ("zlib License", "Licensed under zlib"),
        "OFL-1.1": ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
    }
    for code, title, versions in (("GPL", "General", "1.0 2.0 3.0"), ("LGPL", "Lesser General", "2.1 3.0"),
                                  ("LGPL", "Library General", "2.0"), ("AGPL", "Affero General", "1.0 3.0")):
        gnu = f"GNU {title} Public License"
        for name in versions.split():
            for v in dict.fromkeys((name.removesuffix(".0"), name)):
                published = f"{gnu} as published by the Free Software Foundation"
                found[f"{code}-{name}"] = found.get(f"{code}-{name}", ()) + (
                    f"{gnu}, version {v}", f"{gnu} v{v}", f"{gnu} {v}", f"Version {v} of the {gnu}",
                    f"{published}, either version {v} of the License, or any later version",
                    f"{published}, version {v} of the License",
                    f"under the {code}v{v}", f"{code}v{v} license", f"under the {code}-{v}",
                    f"under the {code} {v}", f"under the {code} v{v}", f"under the {code} version {v}")
    for code in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        title = "-".join({"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}[x]
                         for x in code.split("-"))
        titles = (title, title.replace("NoDerivatives", "NoDerivs")) if "ND" in code else (title,)
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            found[f"CC-{code}-{v}"] = (f"CC {code} {v}", f"CC-{code} {v}", f"CC-{code}-{v}",
                                       *(f"Creative Commons {t} {v}" for t in titles),
                                       *(f"Creative Commons {t} {v} {'International' if v == '4.0' else 'Unported'} "
                                         "License" for t in titles))
    return found


# Further notices, met by windows only. VAGUE ones name a text that nothing else names.
NOTICES = _notices()
VAGUE: dict[str, tuple[str, ...]] = {
    "GPL-1.0-or-later": ("GNU General Public License",),
    "LGPL-2.0-or-later": ("GNU Lesser General Public License", "GNU Library General Public License"),
    "AGPL-1.0-or-later": ("GNU Affero General Public License",),
    "LicenseRef-all-rights-reserved": TEMPLATES["LicenseRef-all-rights-reserved"],
}
# Words without which a text does not name the template's license; and words at which windows are
# aligned where those are too common.
NAMES = frozenset("0bsd affero apache artistic boost bsd by cc cc0 creative eclipse gnu isc lesser library mit "
                  "modified mozilla mpl new sharealike sil simplified universal unencumbered unlicense "
                  "zero-clause zlib".split())
VERBS = frozenset("license licensed redistribution permission reserved".split())
COMMON_NAMES = frozenset("by library mit modified new universal".split())
SPDX = r"(?i)SPDX-License-Identifier:[\s(]*([A-Z0-9](?:[A-Z0-9.-]*[A-Z0-9+])?" \
       r"(?:[\s()]+(?:OR|AND|WITH)[\s()]+[A-Z0-9](?:[A-Z0-9.-]*[A-Z0-9+])?)*)"


def names_it(term: str) -> bool:
    return term in NAMES or bool(re.search(r"[0-9]", term)) or term.startswith(("by-", "attribution", "cc-"))


def window_templates() -> list[tuple]:
    """(template, license, vague, anchor, before, length, must, [(term, n)]) of all notices."""
    rows = []
    for vague, source in ((False, TEMPLATES), (False, NOTICES), (True, VAGUE)):
        for name, texts in source.items():
            if not vague and name in VAGUE:
                continue
            for text in texts:
                words = re.findall(TOKEN, text.lower())
                must = sorted({w for w in words if names_it(w) or w in VERBS})
                anchor = next(w for w in sorted(must, key=lambda w: (
                    w in COMMON_NAMES or bool(re.fullmatch(r"v?[0-9.]+", w)), w in VERBS, words.index(w))))
                rows.append((f"{name}#{len(rows)}", name, vague, anchor, words.index(anchor), len(words), must,
                             sorted(Counter(words).items())))
    return rows


def vocabulary() -> list[str]:
    return sorted({term for _, term, _ in template_terms()})


def full_terms() -> dict[str, Counter]:
    """Term counts of the whole licence texts by license."""
    return {name: Counter(re.findall(TOKEN, text.lower())) for name, text in full_texts().items()}


def full_vocabulary() -> list[str]:
    return sorted({t for row in window_templates() for t, _ in row[-1]}.union(vocabulary(), *full_terms().values()))


def telling() -> str:
    """A pattern that any line similar enough must match: a template word that is no stop word.

    Two texts that share stop words only stay far below the threshold.
    """
    words = [re.escape(w) for w in vocabulary() if w not in STOP_WORDS]
    return rf"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def among(words: str, known: list[str]) -> str:
    """SQL: the ``words`` (an array) that are known; one literal list, as a call for each word is slow to build."""
    return f"filter({words}, t -> t in ({', '.join(repr(w) for w in known)}))"


def term_weights(spark: SparkSession, texts: DataFrame, text_col: str) -> tuple[DataFrame, float]:
    """(term, idf) of both vocabularies, a fixed number of rows; and the idf of a word seen nowhere.

    ``idf = 1 + ln((1 + N) / (1 + df))``, over all texts.
    """
    words = full_vocabulary()
    counted = texts.agg(F.count("*").alias("n")).first()["n"]
    found = texts.select(F.array_distinct(tokens(F.col(text_col))).alias("words")) \
        .select(F.explode(F.expr(among("words", words))).alias("term")) \
        .groupBy("term").agg(F.count("*").alias("df"))
    weights = spark.createDataFrame([(w,) for w in words], "term string").join(found, "term", "left") \
        .select("term", (1 + F.log((1 + F.lit(counted)) / (1 + F.coalesce("df", F.lit(0))))).alias("idf"))
    return weights, 1 + math.log(1 + counted)


def may_be_full(words: str, idf: dict[str, float], threshold: float) -> Column:
    """False only for texts whose distinct ``words`` (SQL) rule out ``threshold`` with every whole licence text.

    A cosine is at most the norm of the template's part that the text shares, over the template's. All but the
    ``HEAVIEST`` words are granted to every text; of these, at least so many must occur as the heaviest
    need to reach the threshold.
    """
    needs = []
    for counts in full_terms().values():
        share = {t: (n * idf[t]) ** 2 for t, n in counts.items()}
        heavy = sorted((t for t in share if idf[t] >= COMMON_IDF), key=lambda t: -share[t])[:HEAVIEST]
        total = sum(share.values())
        lacking = threshold ** 2 * total * (1 - 1e-9) - (total - sum(share[t] for t in heavy))
        least = 0
        while lacking > 0 and least < len(heavy):
            lacking -= share[heavy[least]]
            least += 1
        needs.append((heavy, least))
    if any(least == 0 for _, least in needs):
        return F.lit(True)
    known = sorted(set().union(*(heavy for heavy, _ in needs)))
    enough = " or ".join(f"size({among('h', heavy)}) >= {least}" for heavy, least in needs)
    return F.expr(f"transform(array({among(words, known)}), h -> {enough})[0]")


def full_matches(files: DataFrame, weights: DataFrame, unseen: float, threshold: float) -> DataFrame:
    """(key, license, score): the nearest whole licence text of ``files`` (key, toks), one vector a file."""
    spark = files.sparkSession
    terms = files.dropDuplicates(["key"]).select("key", F.explode("toks").alias("term")) \
        .groupBy("key", "term").agg(F.count("*").alias("tf"))
    weighted = terms.join(F.broadcast(weights), "term", "left") \
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    norms = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    templates = spark.createDataFrame([(name, t, n) for name, c in full_terms().items() for t, n in c.items()],
                                      "license string, term string, n int") \
        .join(F.broadcast(weights), "term").select("license", "term", (F.col("n") * F.col("idf")).alias("tw"))
    template_norms = templates.groupBy("license").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    # bounded by the fixed list of licence texts
    dots = weighted.join(F.broadcast(templates), "term").groupBy("key", "license") \
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    return dots.join(norms, "key").join(F.broadcast(template_norms), "license") \
        .withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6)) \
        .filter(F.col("score") >= threshold) \
        .groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("low"), "license")).alias("m")) \
        .select("key", F.col("m.license").alias("full_license"), (-F.col("m.low")).alias("full_score"))


def line_matches(texts: DataFrame, weights: DataFrame, unseen: float, threshold: float) -> DataFrame:
    """(key, line, template, score, words): lines of ``texts`` (key, text) and their best template."""
    spark = texts.sparkSession
    lines = texts.select("key", F.posexplode(F.split("text", "\n")).alias("line", "body")) \
        .filter(F.lower("body").rlike(telling())) \
        .groupBy("key", "line").agg(F.min("body").alias("body"))  # copies of a text count once
    terms = lines.select("key", "line", F.explode(tokens(F.col("body"))).alias("term")) \
        .groupBy("key", "line", "term").agg(F.count("*").alias("tf"))
    weighted = terms.join(F.broadcast(weights), "term", "left") \
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    norms = weighted.groupBy("key", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
                                                F.sum("tf").alias("words"))
    templates = spark.createDataFrame([(*row, int(names_it(row[1]))) for row in template_terms()],
                                      "template string, term string, n int, named int") \
        .join(F.broadcast(weights), "term") \
        .select("template", "term", (F.col("n") * F.col("idf")).alias("tw"), "named")
    template_norms = templates.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"),
                                                       F.sum("named").alias("names"))
    # bounded by the fixed list of templates
    dots = weighted.join(F.broadcast(templates), "term").groupBy("key", "line", "template") \
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sum("named").alias("named"))
    scored = dots.join(norms, ["key", "line"]).join(F.broadcast(template_norms), "template") \
        .withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6)) \
        .filter((F.col("score") >= threshold) & (F.col("named") == F.col("names")))
    best = F.row_number().over(Window.partitionBy("key", "line").orderBy(F.desc("score"), "template"))
    return scored.withColumn("nr", best).filter("nr = 1").select("key", "line", "template", "score", "words")


def window_matches(texts: DataFrame, weights: DataFrame, unseen: float, threshold: float) -> DataFrame:
    """(key, line, license, vague, score): notices in the token streams of ``texts`` (key, text).

    At each anchor word, each of its templates meets the window that lies around the word as the template
    does around its own, over line ends. ``line`` is that of the window's first word.
    """
    spark = texts.sparkSession
    rows = window_templates()
    anchors = sorted({row[3] for row in rows})
    reach = max(row[5] for row in rows)
    pattern = rf"(?<![a-z0-9])(?:{'|'.join(re.escape(a) for a in anchors)})(?![a-z0-9])"
    layout = spark.createDataFrame([row[:-1] for row in rows], "template string, license string, vague boolean, "
                                   "anchor string, before int, length int, must array<string>")
    templates = spark.createDataFrame([(row[0], t, n) for row in rows for t, n in row[-1]],
                                      "template string, term string, n int") \
        .join(F.broadcast(weights), "term").select("template", "term", (F.col("n") * F.col("idf")).alias("tw"))
    norms = templates.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    stream = texts.filter(F.lower("text").rlike(pattern)).select("key", F.flatten(F.transform(
        F.split("text", "\n"), lambda body, i: F.transform(
            tokens(body), lambda t: F.struct(t.alias("term"), i.alias("line"))))).alias("toks")) \
        .withColumn("words", F.col("toks.term"))
    around = stream.select("key", F.explode(F.expr(
        f"transform(filter(sequence(0, size(words) - 1), i -> words[i] in ({', '.join(map(repr, anchors))})), "
        f"i -> struct(i as at, words[i] as anchor, least(i, {reach}) as left, "
        f"slice(toks, greatest(0, i - {reach}) + 1, {2 * reach}) as near))")).alias("a")).select("key", "a.*")
    # bounded by the templates of an anchor; copies of a text count once
    windows = around.join(F.broadcast(layout), "anchor") \
        .withColumn("body", F.expr("slice(near, greatest(left - before, 0) + 1, "
                                   "length - greatest(before - left, 0))")) \
        .filter(F.size(F.array_except("must", F.col("body.term"))) == 0) \
        .groupBy("key", "at", "template").agg(F.min(F.struct("license", "vague", "body")).alias("m")) \
        .select("key", "at", "template", "m.*")
    weighted = windows.select("key", "at", "template", "license", "vague", F.col("body")[0]["line"].alias("line"),
                              F.explode("body.term").alias("term")) \
        .groupBy("key", "at", "template", "license", "vague", "line", "term").agg(F.count("*").alias("tf")) \
        .join(F.broadcast(weights), "term", "left").join(F.broadcast(templates), ["template", "term"], "left") \
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    return weighted.groupBy("key", "at", "template", "license", "vague", "line").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum(F.col("w") * F.col("tw")).alias("dot")) \
        .join(F.broadcast(norms), "template") \
        .withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6)) \
        .filter(F.col("score") >= threshold).select("key", "line", "license", "vague", "score")


def spdx_matches(texts: DataFrame) -> DataFrame:
    """(key, line, license, vague, score): SPDX expressions as they stand, known identifiers in their own case."""
    known = sorted({*TEMPLATES, *NOTICES, *full_texts()})
    found = texts.filter(F.lower("text").contains("spdx-license-identifier")) \
        .select("key", F.posexplode(F.split("text", "\n")).alias("line", "body")) \
        .select("key", "line", F.regexp_replace(F.regexp_extract("body", SPDX, 1), r"[\s()]+", " ").alias("said")) \
        .filter("said <> ''").distinct()
    names = texts.sparkSession.createDataFrame([(k.lower(), k) for k in known], "low string, known string")
    return found.join(F.broadcast(names), F.lower("said") == F.col("low"), "left").select(
        "key", "line", F.coalesce("known", "said").alias("license"), F.lit(False).alias("vague"),
        F.lit(1.0).alias("score"))


def ancestors(path: Column) -> Column:
    """The directories above a path, nearest first, the root as an empty string last."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, 1, F.size(parts) - i), "/"))


def inherited(dirs: DataFrame, speaking: DataFrame) -> DataFrame:
    """(dir, license, from_dir): for each of ``dirs`` the license of its nearest speaking ancestor or itself."""
    steps = dirs.select("dir", F.posexplode(F.concat(F.array("dir"), F.when(
        F.col("dir") == "", F.array().cast("array<string>")).otherwise(ancestors(F.col("dir")))))
        .alias("up", "from_dir"))
    return steps.join(speaking, "from_dir").groupBy("dir").agg(
        F.min(F.struct("up", "license", "from_dir")).alias("m")) \
        .select("dir", F.col("m.license").alias("dir_license"), F.col("m.from_dir").alias("from_dir"))


def license_scan(files: DataFrame, id_col: str, path: Column, text_col: str = "text",
                 threshold: float = THRESHOLD, file_share: float = FILE_SHARE,
                 file_threshold: float = FILE_THRESHOLD) -> DataFrame:
    """Per row: id, ``path``, ``license``, ``how`` (header, inherited, none), ``score``, ``line``,
    ``from_dir``, ``licence_file``.

    ``score`` and ``line`` (from 0) belong to the best matching line or window of the whole text: the highest
    cosine, then the first line. Where the whole text is a licence text, ``score`` is the cosine of the whole
    and ``line`` is null. Null and empty texts match nothing but inherit; a null path
    lies in the root directory. Several licence files of a directory: whole licence texts first, then the
    highest score, then the smallest license name speaks. Rows with equal texts have equal matches; repeated rows each
    have a row; an empty table gives an empty one. Other columns are not read.
    """
    spark = files.sparkSession
    scratch = Scratch(spark, "licenses")
    rows = files.select(F.col(id_col), F.coalesce(path, F.lit("")).alias("path"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("key", F.xxhash64("text"))
    weights, unseen = term_weights(spark, rows, "text")
    weights = scratch.write(weights.coalesce(1))
    matches = scratch.few(line_matches(
        rows.select("key", "text"), weights.filter(F.col("term").isin(vocabulary())), unseen, threshold))
    texts = rows.select("key", "text")
    notices = matches.select("key", "line", F.split("template", "#")[0].alias("license"),
                             F.lit(False).alias("vague"), "score", "words") \
        .unionByName(window_matches(texts, weights, unseen, threshold).unionByName(spdx_matches(texts))
                     .withColumn("words", F.lit(None).cast("long")))
    own = notices.groupBy("key").agg(
        F.min(F.struct("vague", (-F.col("score")).alias("low"), "line", "license")).alias("m"),
        F.sum("words").alias("license_words")) \
        .select("key", "license_words", F.col("m.license").alias("own"),
                (-F.col("m.low")).alias("score"), F.col("m.line").alias("line"))
    idf = {r["term"]: r["idf"] for r in weights.collect()}  # the fixed vocabulary
    slim = scratch.write(rows.select(id_col, "path", "key", tokens(F.col("text")).alias("toks")).select(
        id_col, "path", "key", F.size("toks").alias("n_words"),
        F.regexp_replace("path", "/?[^/]*$", "").alias("dir"),
        F.when(may_be_full("array_distinct(toks)", idf, file_threshold), F.col("toks")).alias("toks")))
    whole = scratch.few(full_matches(slim.filter(F.col("toks").isNotNull()).select("key", "toks"), weights, unseen,
                                     file_threshold))
    full = F.col("full_license").isNotNull()
    found = scratch.write(slim.drop("toks").join(own, "key", "left").join(whole, "key", "left").select(
        id_col, "path", "key", "dir", F.coalesce("full_license", "own").alias("own"),
        F.coalesce("full_score", "score").alias("score"), F.when(~full, F.col("line")).alias("line"),
        (~full).alias("in_lines"),
        (full | F.coalesce(F.col("license_words") >= file_share * F.col("n_words"), F.lit(False)))
        .alias("licence_file")))
    speaking = found.filter("licence_file").groupBy(F.col("dir").alias("from_dir")).agg(
        F.min(F.struct("in_lines", (-F.col("score")).alias("low"), "own"))["own"].alias("license"))
    by_dir = scratch.few(inherited(found.select("dir").distinct(), speaking))
    how = F.when(F.col("own").isNotNull(), "header").when(F.col("dir_license").isNotNull(), "inherited") \
        .otherwise("none")
    return found.join(by_dir, "dir", "left").select(
        id_col, "path", F.coalesce("own", "dir_license").alias("license"), how.alias("how"), "score", "line",
        F.when(how == "inherited", F.col("from_dir")).alias("from_dir"), "licence_file")
