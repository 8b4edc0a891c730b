"""License scan (operator 9): DataFrame functions only.

Sentences of a file, also those wrapped over several lines, are compared with licence templates by
sparse TF-IDF cosine; a file without a statement of its own inherits from the nearest ancestor
directory that holds a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: The usual header of the GNU licences, and which they are.
_FREE = "you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
_GNU = (
    ("GPL-2.0", "General Public License", "2"),
    ("GPL-3.0", "General Public License", "3"),
    ("LGPL-2.1", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "Lesser General Public License", "3"),
    ("AGPL-3.0", "Affero General Public License", "3"),
)
_SPDX = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")
#: Fixed values: (licence, statement as it stands in headers and licence files).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "The ASF licenses this file to You under the Apache License, Version 2.0"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *[(name, _FREE.format("GNU " + kind, number)) for name, kind, number in _GNU],
    *[(name, f"SPDX-License-Identifier: {name}") for name in _SPDX],
)
TOKEN = "[a-z0-9]+"
#: Ends of the units compared: line ends and white space after a sentence.
UNIT = r"\n|(?<=[.!?;])\s+"
#: A statement may be wrapped over so many lines; comment marks before a line's text.
LINES, MARKS = 6, r"^[\s#*/;%!<>|-]+|^(?i:dnl|rem|//|--)\s+"
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)[^/]*$"


def vocabulary(templates: tuple = TEMPLATES) -> list[str]:
    return sorted({t for _, text in templates for t in re.findall(TOKEN, text.lower())})


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def parts(text: Column, has) -> Column:
    """What is compared with the templates: the units of ``text``, and all runs of 2 to ``LINES``
    consecutive lines without their comment marks and blank lines, cut before and after sentences.

    A run is made only where one of its lines ``has`` an anchor word: a cheap test first.
    """
    units = F.filter(F.split(text, UNIT), has)
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, MARKS, ""))), lambda x: x != "")
    at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: has(F.get(lines, i)))
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(i - (LINES - 1), F.lit(0)), i))))
    runs = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(2), F.lit(LINES)), lambda k: F.array_join(F.slice(lines, i + 1, k), " "))))
    sentences = F.flatten(F.transform(runs, lambda r: F.array_append(F.split(r, r"(?<=[.!?;:])\s+"), r)))
    wrapped = F.when(F.size(lines) > 1, F.filter(sentences, has)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(units, wrapped))


def frequencies(texts: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """(texts, texts that hold each word) over all rows of ``texts`` (a column ``text``)."""
    held = F.array_intersect(F.array_distinct(tokens(F.col("text"))), F.array(*[F.lit(w) for w in words]))
    rows = texts.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("t")).groupBy("t").count().collect()
    df = {r.t: r["count"] for r in rows}
    return df.pop("", 0), df


def weights(n: int, df: dict[str, int], templates: tuple) -> tuple[dict[str, float], list[dict[str, float]]]:
    """(idf by vocabulary word, unit vector of each template)."""
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary(templates)}
    out = []
    for _, text in templates:
        v = {t: c * idf[t] for t, c in Counter(re.findall(TOKEN, text.lower())).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({t: x / norm for t, x in v.items()})
    return idf, out


def anchors(vectors: list[dict[str, float]], least: float) -> list[str]:
    """Words of which a unit must hold one to reach the cosine ``least`` with any template.

    Without a template's heaviest words, what is left of it is shorter than ``least``.
    """
    out = set()
    for v in vectors:
        rest = 1.0
        for t, x in sorted(v.items(), key=lambda kv: (-kv[1], kv[0])):
            if rest < least * least * (1 - 1e-9):
                break
            out.add(t)
            rest -= x * x
    return sorted(out)


def may_reach(unit: Column, idf: dict[str, float], unseen: float, least: float) -> Column:
    """Whether a unit can have a cosine of ``least`` with any template: template words alone make up
    that share of its length. One pass over the sorted words, in the row, before any word is a row."""
    table = F.create_map(*[F.lit(x) for item in sorted(idf.items()) for x in item])

    def closed(s: Column) -> tuple[Column, Column]:
        known = F.try_element_at(table, s["word"])
        w = s["run"] * F.coalesce(known, F.lit(unseen))
        k = s["run"] * F.coalesce(known, F.lit(0.0))
        return s["all"] + w * w, s["known"] + k * k

    def state(word: Column, run: Column, both: tuple[Column, Column]) -> Column:
        return F.struct(word.alias("word"), run.alias("run"), both[0].alias("all"), both[1].alias("known"))

    def step(s: Column, t: Column) -> Column:
        return F.when(t == s["word"], state(s["word"], s["run"] + 1, (s["all"], s["known"]))).otherwise(state(t, F.lit(1), closed(s)))

    start = state(F.lit(""), F.lit(0), (F.lit(0.0), F.lit(0.0)))
    return F.aggregate(F.array_sort(tokens(unit)), start, step, lambda s: closed(s)[1] >= (least * least - 1e-6) * closed(s)[0])


def statements(files: DataFrame, least: float = 0.75, templates: tuple = TEMPLATES) -> DataFrame:
    """``path, license, cosine``: the best statement of each file that has one (ties: by name).

    Document frequencies are counted for the words of the templates; any other word weighs as one
    that no other text holds, so words beside a statement in its sentence lower its cosine. The
    texts are read twice: for the frequencies, and for the units, which are written.
    """
    spark = files.sparkSession
    texts = files.select("path", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n, df = frequencies(texts, vocabulary(templates))
    idf, vectors = weights(n, df, templates)
    pattern = r"(?<![a-z0-9])(" + "|".join(anchors(vectors, least)) + r")(?![a-z0-9])"
    has = lambda u: F.lower(u).rlike(pattern)
    found = texts.where(has(F.col("text"))).select("path", F.posexplode(parts(F.col("text"), has)).alias("pos", "unit"), F.xxhash64("text").alias("version"))
    unseen = math.log(1 + n) + 1  # a word outside of the vocabulary counts as one seen nowhere else
    units = written(found.where(may_reach(F.col("unit"), idf, unseen, least)), "units")
    key = ["path", "version", "pos"]
    tf = units.select(*key, F.explode(tokens(F.col("unit"))).alias("t")).groupBy(*key, "t").agg(F.count(F.lit(1)).alias("tf"))
    # Both tables are the templates': some hundred rows whatever the input.
    idf_rows = F.broadcast(spark.createDataFrame(sorted(idf.items()), "t string, idf double"))
    vector_rows = F.broadcast(spark.createDataFrame([(i, t, x) for i, v in enumerate(vectors) for t, x in v.items()], "template int, t string, x double"))
    names = F.broadcast(spark.createDataFrame([(i, name) for i, (name, _) in enumerate(templates)], "template int, license string"))
    weighed = tf.join(idf_rows, "t", "left").select(*key, "t", (F.col("tf") * F.coalesce("idf", F.lit(unseen))).alias("w"))
    norm = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = weighed.join(vector_rows, "t").groupBy(*key, "template").agg(F.sum(F.col("w") * F.col("x")).alias("dot"))
    cosine = dot.join(norm, key).select("path", "template", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")).where(F.col("cosine") >= least)
    best = cosine.join(names, "template").groupBy("path").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
    return best.select("path", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def parent(path: Column) -> Column:
    """The directory of a path; the top is the empty string, whose parent is null."""
    return F.when(path == "", F.lit(None).cast("string")).otherwise(F.regexp_replace(path, "/?[^/]*$", ""))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", least: float = 0.75, licence_file: str = LICENCE_FILE, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per row of ``files``: ``path, own_license, cosine, license, inherited_from``.

    ``own_license``: the file's own best statement with a cosine of ``least`` or more, else null.
    ``license``: that, or else the one of the nearest directory at or above the file with a licence
    file (of several in a directory the best statement, then the first path). A null path has no
    directory and inherits nothing; a null or empty text states nothing; equal paths share their
    statements; an empty table gives none. Whole texts are read. Directories are joined, not
    files: the ancestors of each distinct directory are looked up once.
    """
    src = files.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    own = written(statements(src.where("path is not null"), least, templates), "own")
    paths = src.select("path", parent(F.col("path")).alias("dir"))
    licence_dirs = own.where(F.col("path").rlike(licence_file)).groupBy(parent(F.col("path")).alias("above")).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "license")).alias("b"))
    licence_dirs = licence_dirs.select("above", F.col("b.license").alias("dir_license"))
    dirs = paths.where("dir is not null").select("dir").distinct()
    names = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", F.lit(0)).otherwise(F.size(names))), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(names, 1, k), "/").alias("above")))
    found = dirs.select("dir", F.inline(ups)).join(licence_dirs, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "dir_license")).alias("b"))
    found = found.select("dir", F.col("b.above").alias("above"), F.col("b.dir_license").alias("dir_license"))
    out = paths.join(own, "path", "left").join(found, "dir", "left")
    return out.select(
        "path",
        F.col("license").alias("own_license"),
        "cosine",
        F.coalesce("license", "dir_license").alias("license"),
        F.when(F.col("license").isNull(), F.col("above")).alias("inherited_from"),
    )
