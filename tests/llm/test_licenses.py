"""License scans: base phrases by brute force, rules by example, all figures against SQL."""

import re

import duckdb

import check
from pitpanel.llm import licenses, queries
from pitpanel.llm.sql import SQL


def run(spark, texts, **extra):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    return {r["doc_id"]: r for r in licenses.digest(licenses.scan(df)).collect()}


def test_base_places(spark):
    texts = ["MIT License, mit\nLICENSE!", "the mit-license mitt license", "", None, "--", "É mit license é", "gnu General   public/License", "x" * 50_000 + " apache license " * 3, "MİT license"]
    got = run(spark, texts)
    for k, text in enumerate(texts):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        row = got[k]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min((i for i, _ in places), default=None) and row["last_word"] == max((i for i, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert 0 <= row["score"] <= 1


def test_priority_and_containment(spark):
    texts = ["SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 2.0.", "GNU Affero General Public License v3", "mit license",
             "the BSD 3-Clause license and the BSD license", "Lizenz mit allem", "all rights reserved"]
    got = run(spark, texts)
    assert [got[k]["labels"] for k in range(7)] == ["apache-2.0", "apache,apache-2.0", "agpl-3.0,gpl", "mit", "bsd,bsd-3-clause", "", "proprietary"]
    assert [got[k]["score"] for k in range(7)] == [1.0, 0.95, 0.8, 0.8, 0.8, 0.0, 0.8]


def test_rules_are_hundreds_and_all_match_something():
    rules = licenses.rules()
    assert len(rules) > 300 and len({r[0] for r in rules}) > 100
    assert all(k for r in rules for k in r[2:4])


def test_license_texts_without_their_name(spark):
    texts = [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute',
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice",
        "Redistribution and use in source and binary forms, with or without modification,\n * are permitted provided that the following conditions are met: neither the name of X may be used to endorse or promote products derived from this software without specific prior written permission.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "permission to use this house", "redistribution of wealth and use of source",
    ]
    got = run(spark, texts)
    assert [got[k]["labels"] for k in range(7)] == ["mit", "isc", "bsd,bsd-3-clause", "apache-2.0", "mpl-2.0", "", ""]
    assert [got[k]["score"] for k in range(7)] == [0.9] * 5 + [0.0] * 2
    assert sum(r[1] == licenses.BODY for r in licenses.rules()) > 130


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "mit license", "a", "b"), (1, "mit license", None, None)], "doc_id long, text string, words string, rule string")
    out = licenses.scan(df)
    assert out.columns == ["doc_id", "text", "words", "rule", "license_scan"] and out.count() == 2
    assert licenses.scan(df.limit(0)).count() == 0


def test_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    df = queries.op1_license_scans(spark, small)
    res = con.execute(SQL["op1_license_scans"])
    names = [d[0] for d in res.description]
    assert check.canonical(df.columns, [tuple(r) for r in df.collect()]) == check.canonical(names, res.fetchall())


def test_no_python_in_the_plan(spark, small):
    plan = queries.op1_license_scans(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
