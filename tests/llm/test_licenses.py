import pytest

from foliary.llm import licenses
from tests.llm.fixture import documents, rows, same

CASES = [
    (1, None, None),
    (2, "", "s"),
    (3, "Licensed under CC BY-NC 4.0. All Rights Reserved, all rights reserved", "s"),
    (3, "Licensed under CC BY-NC 4.0. All Rights Reserved, all rights reserved", "s"),
    (4, "GNU general public license, version 3", "s"),
    (5, "public license general", "s"),
    (6, "ccby cc_by cc\x00by cc\nby", "s"),
    (7, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", None),
    (8, "license " * 30000 + "cc by", "s"),
    (9, "édition cc by naïve", "s"),
    (10, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, and so on", "s"),
    (11, "of charge to any person obtaining a copy free of charge", "s"),
    (12, "free software foundation, either version 3; as published by the Free Software Foundation, either version 3 of the License", "s"),
    (13, " ".join(licenses.TEMPLATES[3].words), "s"),
    (14, "general general public public license license general public license", "s"),
]


def test_same_as_sql(spark):
    docs = documents(spark, CASES)
    same(licenses.report(docs), licenses.sql(), documents=docs)
    found = {r["doc_id"]: r for r in rows(licenses.report(docs))}
    assert found[3]["n_base"] == 3 and found[3]["base_labels"] == "cc-by,reserved" and found[3]["labels"] == "cc-by,cc-by-nc,reserved"
    assert (found[6]["first_word"], found[6]["last_word"]) == (1, 5)
    assert found[5]["labels"] == "" and found[5]["score"] == 0
    assert found[7]["labels"] == "apache-2.0,mit" and found[7]["score"] == 1
    assert found[8]["first_word"] == 30000


def test_empty_table(spark):
    docs = documents(spark, CASES).limit(0)
    assert licenses.report(docs).count() == 0


def test_keeps_other_columns(spark):
    out = licenses.scan(documents(spark, CASES))
    assert {"doc_id", "source", "size", "score", "n_words", "matches"} <= set(out.columns)
    named = documents(spark, CASES).selectExpr("doc_id", "text", "'w' AS words", "'h' AS hits", "'r' AS row", "1 AS n_words")
    got = licenses.scan(named).collect()
    assert {(r.words, r.hits, r.row) for r in got} == {("w", "h", "r")} and max(r.n_words for r in got) > 30000


def test_no_python_in_the_plan(spark):
    plan = licenses.report(documents(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_licences_are_covered(spark):
    got = {r["doc_id"]: r for r in rows(licenses.report(documents(spark, CASES)))}
    assert got[13]["labels"] == "mit" and got[13]["score"] == 1 and 0 < got[10]["score"] < 0.7
    assert got[11]["labels"] == "" and got[12]["labels"] == "gpl" and got[14]["n_base"] == 1


@pytest.mark.parametrize("t", licenses.BASE + licenses.TEMPLATES, ids=lambda t: " ".join(t.key))
def test_key_stands_in_its_template(t):
    assert t.words[t.key_at : t.key_at + len(t.key)] == t.key
