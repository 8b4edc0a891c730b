import math
import re
from collections import Counter

from gristmill.llm import license_scan as L
from gristmill.llm import queries


def brute(files, least=0.75):
    texts = [t or "" for p, t in files if p is not None]
    df = Counter(w for t in texts for w in set(re.findall(L.TOKEN, t.lower())))
    n = len(texts)
    idf = lambda w: math.log((1 + n) / (1 + (df[w] if w in words else 0))) + 1
    words = set(L.vocabulary())
    unit = lambda v: {k: x / math.sqrt(sum(y * y for y in v.values())) for k, x in v.items()}
    vec = lambda t: unit({w: c * idf(w) for w, c in Counter(re.findall(L.TOKEN, t.lower())).items()})
    templates = [(name, vec(t)) for name, t in L.TEMPLATES]
    own = {}
    for p, t in files:
        if p is None:
            continue
        for s in re.split(L.UNIT, t or ""):
            v = vec(s) if re.search(L.TOKEN, s.lower()) else {}
            for name, w in templates:
                c = round(sum(x * w.get(k, 0) for k, x in v.items()), 9)
                if c >= least:
                    own[p] = min(own.get(p, (0, "")), (-c, name))
    at = {}
    for p, (c, name) in own.items():
        if re.search(L.LICENCE_FILE, p):
            d = p.rpartition("/")[0]
            at[d] = min(at.get(d, (0, "", "")), (c, p, name))
    out = []
    for p, _ in files:
        if p in own:
            out.append((p, own[p][1], own[p][1], None))
            continue
        d, got = (p or "").rpartition("/")[0], (None, None)
        while p is not None:
            if d in at:
                got = (at[d][2], d)
                break
            if d == "":
                break
            d = d.rpartition("/")[0]
        out.append((p, None, *got))
    return sorted(out, key=str)


FILES = [
    ("LICENSE", "Released under the MIT License."), ("a/x.py", "code here"), ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    ("a/b/c/d/y.py", "more code"), ("a/b/z.py", "# Licensed under the Apache License, Version 2.0.\nimport x"), ("a/b/c/NOTICE", "no statement"), ("top.py", None),
    (None, "Released under the MIT License."), ("e/LICENSE-A", "Licensed under CC BY-NC 4.0."), ("e/LICENSE-B", "Licensed under CC BY-NC 4.0."), ("e/f", ""), ("e/f", ""), ("e//g/h", "x"),
    ("long.txt", "filler words " * 5000 + ". Released under the MIT License. " + "tail " * 100), ("near.txt", "license version the under public general"),
]


def test_small_tree(spark):
    df = spark.createDataFrame([(*f, "c", 1.0) for f in FILES], "path string, text string, license string, cosine double")
    got = L.scan(df)
    assert sorted(((r.path, r.own_license, r.license, r.inherited_from) for r in got.collect()), key=str) == brute(FILES)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert L.scan(df.limit(0)).count() == 0


def test_query_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    files = [(r.path, r.text) for r in queries.as_files(docs).select("path", "text").collect()]
    got = queries.op9_license_scan(spark, sf).collect()
    assert sorted(((r.path, r.own_license, r.license, r.inherited_from) for r in got), key=str) == brute(files)
    assert len(got) == docs.count() and any(r.own_license for r in got) and any(r.inherited_from is not None for r in got)


BSD = """Copyright (c) 2020, Somebody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
"""
ASF = """/*
 * Licensed to the Apache Software Foundation (ASF) under one or more
 * contributor license agreements.  See the NOTICE file distributed with
 * this work for additional information regarding copyright ownership.
 * The ASF licenses this file to You under the Apache License, Version 2.0
 * (the "License"); you may not use this file except in compliance with
 * the License.
 */
"""
WRAPPED = [
    ("bsd/LICENSE", BSD, "BSD-3-Clause"), ("gpl/a.py", GPL, "GPL-3.0"), ("asf/A.java", ASF, "Apache-2.0"),
    ("gnu/x.txt", "This work is licensed under the GNU\nGeneral Public License, version 3.", "GPL-3.0"),
    ("lgpl/COPYING", "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n", "LGPL-2.1"),
    ("spdx/a.c", "// SPDX-License-Identifier: MIT\nint main;", "MIT"), ("plain/a.txt", "No statement\nof any kind\nstands here.", None),
]


def test_wrapped_statements(spark):
    filler = [(f"o/{i}", f"other words {i}\nof no licence at all") for i in range(40)]
    df = spark.createDataFrame([(p, t) for p, t, _ in WRAPPED] + filler + [("bsd/src/a.c", "int a;")], "path string, text string")
    got = {r.path: (r.own_license, r.license) for r in L.scan(df).collect()}
    assert {p: got[p][0] for p, _, _ in WRAPPED} == {p: name for p, _, name in WRAPPED}
    assert got["bsd/src/a.c"] == (None, "BSD-3-Clause") and all(got[p] == (None, None) for p, _ in filler)
