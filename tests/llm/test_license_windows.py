"""Licenses within longer lines and paragraphs, by brute force over all windows."""

import os
import re

import duckdb
import pytest

from millrace.llm import licenses

DATA = "/root/testdata/sf0.001"


def words_of(text):
    return [w.lower() for w in re.findall("[A-Za-z0-9]+", text)]


def grams_of(words):
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} or {f"{w} " for w in words}


def brute_force(text, templates=licenses.TEMPLATES):
    text = text or ""
    units = {tuple(words_of(u)) for u in [text, *re.split(r"\n[ \t\r]*\n", text), *text.split("\n")]} - {()}
    words, found, n_units = words_of(text), [], set()
    for name, body in templates.items():
        own, n = grams_of(words_of(body)), len(words_of(body))
        windows = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n > 1 else set()
        for unit in units | windows:
            grams = grams_of(list(unit))
            dice = 2 * len(grams & own) / (len(grams) + len(own))
            if dice >= licenses.THRESHOLD:
                found.append((-dice, name, -len(grams & own)))
                n_units |= {unit} & units
    if not found:
        return None, 0.0, 0, None, None
    dice, name, _ = min(found)
    return name, -dice, len(n_units), ",".join(sorted({f[1] for f in found})), min((s, d, name) for d, name, s in found)[2]


def edited(text, every):
    words = text.split()
    return " ".join("changed" if k % every == every // 2 else w for k, w in enumerate(words))


PROSE = "Some words about another matter come before, and the rights of readers are reserved for later. "
TEXTS = [
    "Copyright 2020 Acme Inc. All rights reserved.",
    PROSE + "This work is licensed\nunder the GNU General\nPublic License, version 2. " + PROSE,
    PROSE + "This work is licensed under the GNU General Public License, version 3. " + PROSE,
    PROSE * 5 + "\n\n" + licenses.TEMPLATES["mit-text"] + "\n" + PROSE,
    "Copyright (c) 2001 A. All rights reserved.\n" + licenses.TEMPLATES["bsd-2-clause-text"],
    "Copyright (c) 2001 A. All rights reserved.\n" + edited(licenses.TEMPLATES["bsd-3-clause-text"], 23),
    PROSE + edited(licenses.TEMPLATES["isc-text"], 19) + PROSE * 3,
    PROSE + edited(licenses.TEMPLATES["apache-2.0-header"], 4),
    "All rights reserved. " * 50, PROSE * 40, "rights", None, "", " \n\n ", "é" * 50, licenses.TEMPLATES["lgpl-2.1-header"] + " " + licenses.TEMPLATES["mpl-2.0"],
    "Copyright 2020 Acme Inc. All rights reserved.",
]


def scanned(frame, **options):
    return [tuple(r)[1:] for r in licenses.scan(frame, **options).orderBy("doc_id").collect()]


def test_windows_by_brute_force(spark):
    frame = spark.createDataFrame([(k, t, "x", 1.0, "y") for k, t in enumerate(TEXTS)], "doc_id long, text string, license string, dice double, grams string")
    got = scanned(frame)
    assert got == [brute_force(t) for t in TEXTS]
    assert [g[4] for g in got[:7]] == ["all-rights-reserved", "gpl-2.0", "gpl-3.0", "mit-text", "bsd-2-clause-text", "bsd-3-clause-text", "isc-text"]
    assert got[7][0] is None and got[9][0] is None
    assert scanned(frame.limit(0)) == []


def test_templates_of_one_word_and_none(spark):
    frame = spark.createDataFrame(list(enumerate(["copyleft", "a copyleft notice", "x\nCopyLeft\ny", None])), "doc_id long, text string")
    for templates in ({"one": "Copyleft", "two": "copyleft notice"}, {"blank": " . "}, {}):
        assert scanned(frame, templates=templates) == [brute_force(t, {k: v for k, v in templates.items() if words_of(v)}) for (t,) in frame.select("text").collect()]


@pytest.mark.parametrize("name", ["documents"])
def test_sql(spark, name):
    con = duckdb.connect()
    path = os.path.join(DATA, f"{name}.parquet")
    rows = con.sql(f"SELECT doc_id, text FROM '{path}'").fetchall() + [(10**6 + k, t) for k, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    con.register("documents", frame.toArrow())
    columns = ["doc_id", "license", "dice", "n_units", "licenses", "widest"]
    want = sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({licenses.oracle_sql()})").fetchall())
    assert sorted(map(tuple, licenses.scan(frame).select(columns).collect())) == want
