import re

from tests.llm.helpers import MIDDLE, documents, oracle, rows, same_rows
from trajspark.llm import licenses, queries

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def slow_base(doc_id, text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    found = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(words))
             if words[k:k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return (doc_id, len(words), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in found})))


MIT = licenses.TEXTS[0][1]
CASES = [
    (1, "Released under the MIT License."), (2, "under  the\nMIT--license under THE mit license"),
    (3, "cc by nc cc-by-NC, CC BY N C"), (4, None), (5, ""), (6, "under the mitlicense"),
    (7, "Apache License, Version 2.0 apache license version 20"), (8, "cc by"), (9, "a b"),
    (10, "under the Kit mit license"), (11, "under the MİT license é-ñ"),
    (12, "x " * 60_000 + "cc by nc"), (1, "Released under the MIT License."),
    (None, "cc by nc")]


def test_whole_table(spark):
    same_rows(queries.op6_license_scan(spark, MIDDLE).toPandas(),
              oracle(licenses.ORACLE_SQL, MIDDLE))


def test_base_cases(spark):
    docs = documents(spark, [(i, t, "s") for i, t in CASES], "h hash place spot template label")
    assert rows(licenses.license_scan(docs), *COLUMNS) == sorted(
        (slow_base(i, t) for i, t in CASES), key=repr)
    assert licenses.license_scan(documents(spark, [])).count() == 0


def test_spans_with_edits(spark):
    words = MIT.split()
    edited = words[:10] + ["truly"] + words[10:25] + words[26:]
    cases = [(1, MIT.upper()), (2, "start " * 50 + " ".join(edited)),
             (3, " ".join(words[:len(words) // 3])), (4, " ".join(reversed(words))),
             (5, " ".join(words[0::2])), (6, MIT + " filler " * 9 + MIT)]
    docs = documents(spark, [(i, t, "s") for i, t in cases])
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert [got[k].labels for k in range(1, 7)] == ["mit", "mit", "", "", "", "mit"]
    assert got[1].score == got[6].score == 1.0 and 0.6 < got[2].score < 1.0
    assert 0.2 < got[3].score < 0.6 and got[4].score == 0.0
    assert not any(got[k].n_base for k in got)


def test_own_templates(spark):
    docs = documents(spark, [(1, "one two three four five six", "s"), (2, "one two three", "s")])
    got = {r.doc_id: (r.n_base, r.labels) for r in licenses.license_scan(
        docs, phrases=(("one two three", "p"),),
        templates=(("t", "two three four five six"),)).collect()}
    assert got == {1: (1, "p,t"), 2: (1, "p")}


COMMONS = "This work is licensed under a Creative Commons {} 4.0 International License."
GNU = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU "
       "{} Public License as published by the Free Software Foundation; either version 3")
CLOSE = [
    (COMMONS.format("Attribution"), "cc-by"), (COMMONS.format("Attribution-ShareAlike"), "cc-by-sa"),
    (COMMONS.format("Attribution-NonCommercial"), "cc-by-nc"),
    (COMMONS.format("Attribution-NoDerivatives"), "cc-by-nd"),
    (COMMONS.format("Attribution-NonCommercial-ShareAlike"), "cc-by-nc-sa"),
    (COMMONS.format("Attribution-Something"), ""),
    ("licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License", "cc-by-nd"),
    (GNU.format("program", "General"), "gpl"), (GNU.format("library", "Lesser General"), "lgpl"),
    (GNU.format("program", "Lesser General"), "lgpl"), (GNU.format("program", "Affero General"), "agpl"),
    ("Licensed under the GNU Lesser General Public License", "lgpl"),
    ("Licensed under the GNU General Public License", "gpl"),
    ("under the gnu " * 3, ""), ("under the gnu " * 4000, ""),
    ("licensed under the apache license of the apache license version", ""),
    (" ".join(MIT.split()[::-1]), ""),
    (GNU.format("program", "General") + " x " + COMMONS.format("Attribution"), "cc-by,gpl"),
    (COMMONS.format("Attribution") + " " + COMMONS.format("Attribution-ShareAlike"), "cc-by,cc-by-sa"),
    ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
     "in compliance with the License.", "apache-2")]


def test_close_licenses_are_told_apart(spark):
    docs = documents(spark, [(k, t, "s") for k, (t, _) in enumerate(CLOSE)])
    got = {r.doc_id: r.labels for r in licenses.license_scan(docs).collect()}
    assert [(t, got[k], wanted) for k, (t, wanted) in enumerate(CLOSE) if got[k] != wanted] == []


def test_cases_by_sql(spark):
    import duckdb
    import pandas as pd
    cases = [(1000 + k, t) for k, (t, _) in enumerate(CLOSE)] + [c for c in CASES if c[0] not in (1, None)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(cases, columns=["doc_id", "text"]).convert_dtypes())
    docs = documents(spark, [(i, t, "s") for i, t in cases if i != 11])
    twin = con.execute(licenses.ORACLE_SQL).df()
    same_rows(licenses.license_scan(docs).toPandas(), twin[twin.doc_id != 11])


def test_hot_copies(spark):
    """Rows that agree in doc_id and text are counted once and come back each."""
    docs = documents(spark, [(None, CLOSE[0][0], "s")] * 300 + [(None, CLOSE[7][0], "s")] * 2)
    got = [r.labels for r in licenses.license_scan(docs).collect()]
    assert sorted(got) == ["cc-by"] * 300 + ["gpl"] * 2
