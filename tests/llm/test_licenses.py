import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from camstat.llm import licenses, queries
from tests.llm.helpers import SF, docs, duck, same

RULES = licenses.rules()


def run(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = licenses.summary(licenses.scan(df, ["doc_id"]), ["doc_id"]).orderBy("doc_id").collect()
    return [r.asDict() for r in got]


def base_of(text):
    """Base phrases by plain comparison of words."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = [(i, label) for i in range(len(words)) for phrase, label in licenses.BASE.items()
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places})))


def test_query_against_sql(spark):
    same(queries.op12_licenses(spark, SF).toPandas(), duck(queries.ORACLES["op12_licenses"]))


def test_no_python_in_the_plan(spark):
    plan = queries.op12_licenses(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_base_places(spark):
    texts = ["under the mit license under the MIT License", "cc by nc cc-by-nc CC_BY\nNC", "apache license, version 2.0; apache licence version 2",
             "Über the mit license", "underthe mit license", "x under the mit licenses", "under the mıt license under the mitK license",
             "ünder the mit license", "cc by nc" + " x cc by nc" * 3000, "", None, "...", "ÀCC BY NC", "\x00cc\x7fby~nc\x00"]
    for got, text in zip(run(spark, texts), texts):
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == base_of(text), text


LABELS = [
    ("SPDX-License-Identifier: Apache-2.0", "apache-2"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3-or-later"),
    ("// SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", "cc-by-nc,cc-by-nc-sa"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("Released under the GNU Lesser General Public License v2.1 or any later version", "lgpl-2.1-or-later"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("distributed under the terms of the Eclipse Public License 2.0", "epl-2"),
    ("MIT License and the 3-Clause BSD License", "bsd-3,mit"),
    ("LICENCE: Mozilla Public Licence, v. 2.0 (MPL)", "mpl-2"),
    ("you may get a driving license at the office", ""),
    ("we met under the tree, with the apache helicopter version 2", ""),
    ("Mozilla Public License v2.0", "mpl-2"),
]


def test_labels(spark):
    for got, (text, labels) in zip(run(spark, [t for t, _ in LABELS]), LABELS):
        assert got["labels"] == labels, text
        assert (got["score"] > 0.6) == bool(labels)


def test_containment_and_priority(spark):
    df = spark.createDataFrame([(1, "licensed under the gnu general public license version 3 and gnu general public license")], "doc_id long, text string")
    finds = licenses.scan(df, ["doc_id"]).first()["finds"]
    assert [(f["label"], f["start"], f["end"]) for f in finds] == [("gpl-3", 0, 9), ("gpl", 10, 14)]


def required(pattern):
    """What every match of a pattern holds, optional and alternative parts replaced by a mark."""
    out = []

    def walk(parts):
        for kind, arg in parts:
            if str(kind) == "LITERAL":
                out.append(chr(arg))
            elif str(kind) == "SUBPATTERN":
                walk(arg[3])
            else:
                out.append("\1")

    walk(re._parser.parse(pattern))
    return "".join(out)


def test_gates_hold_what_rules_find():
    """No find of a rule can miss its keyword or all roots."""
    for rule in RULES:
        sure = required(rule.pattern)
        assert rule.keyword in sure and any(root in sure for root in licenses.ROOTS), rule


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(RULES), st.data())
def test_examples_of_rules(rule, data):
    """A text made from a pattern is found, whatever its case and separators."""
    example = data.draw(st.from_regex(re.compile(rule.pattern, re.A), fullmatch=True))
    assert re.search(rule.pattern, "  ".join(["", *re.findall("[a-z0-9]+", example.upper().lower()), ""]).replace("  ", "  ")[1:-1])


def test_rule_table():
    assert len(RULES) > 400 and len({r.label for r in RULES}) > 120
    assert [r.priority for r in RULES] == sorted((r.priority for r in RULES), reverse=True)
    assert all(re.compile(r.pattern) and 0 < r.strength <= 1 and r.priority in (1, 2, 3, 4) for r in RULES)


def test_edge_cases(spark):
    df = docs(spark).withColumnRenamed("fp", "finds").withColumnRenamed("key", "n_words")
    got = licenses.summary(licenses.scan(df, ["doc_id"]), ["doc_id"])
    assert got.count() == 11 and got.where(F.col("labels") != "").count() == 0
    assert {r["n_words"] for r in got.where("doc_id IN (3, 4, 5)").collect()} == {0}
    assert licenses.summary(licenses.scan(docs(spark, []), ["doc_id"]), ["doc_id"]).count() == 0
