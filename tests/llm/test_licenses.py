"""Licence notices: each family is found, ordinary paragraphs aren't."""

import pytest

from riverbend.llm import licenses as L
from riverbend.sources.tables import read_table

from conftest import SF_MID


@pytest.fixture(scope="module")
def model(spark):
    return L.train(read_table(spark, SF_MID, "documents"))


def test_templates_and_variants(spark, model):
    rows, expected = [], set()
    for k, (family, templates) in enumerate(L.TEMPLATES.items()):
        for j, t in enumerate(templates):
            rows.append((100 * k + j, f"Some first line of text.\n{t}\nand a last one"))
            expected.add((100 * k + j, 1, family))
            rows.append((1000 + 100 * k + j, f"note: {t.upper()} thanks"))
            expected.add((1000 + 100 * k + j, 0, family))
    got = {(r.doc_id, r.line, r.family) for r in L.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert len(got & expected) >= 0.95 * len(expected) and got <= expected


def test_ordinary_paragraphs(spark, model):
    rows = [(k, t) for k, t in enumerate([*L.EVERYDAY, "The license plate was reserved for version 3 of the car.", "A general public work is free.", "", None, "\n\n"])]
    assert L.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).count() == 0


def test_sample_table(spark, model):
    docs = read_table(spark, SF_MID, "documents", ["doc_id", "text"])
    marks = {"GPL": "GNU General Public License", "CC-BY-NC": "CC BY-NC 4.0", "MIT": "the MIT License", "Apache-2.0": "the Apache License", "reserved": "All rights reserved"}
    expected = {(r.doc_id, n, f) for r in docs.collect() for n, line in enumerate((r.text or "").split("\n")) for f, mark in marks.items() if mark in line}
    got = {(r.doc_id, r.line, r.family) for r in L.find_licenses(docs, model).collect()}
    assert expected and got == expected


def test_odd_rows(spark, model):
    notice = "Released under the MIT License."
    rows = [(1, notice, "x", 1)] * 2 + [(None, "x\n" * 50_000 + notice, "x", 1)]
    out = L.find_licenses(spark.createDataFrame(rows, "doc_id long, text string, family string, line int"), model).collect()
    assert sorted((r.line, r.family) for r in out) == [(0, "MIT"), (0, "MIT"), (50_000, "MIT")]
    assert all(0.5 <= r.probability <= 1 and r.similarity == 1 for r in out)
    assert L.find_licenses(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


WRAPS = {"plain": ("", "\n"), "shell": ("# ", "\n"), "star": (" * ", "\r\n"), "slashes": ("// ", "\n"), "sql": ("-- ", "\n"), "basic": ("REM ", "\n"), "m4": ("dnl ", "\n")}


def wrap(text, parts, mark, end):
    tokens = text.split()
    cuts = [len(tokens) * k // parts for k in range(parts + 1)]
    return end.join(mark + " ".join(tokens[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


def test_wrapped_notices(spark, model):
    rows, expected = [], set()
    for family, templates in L.TEMPLATES.items():
        for t in templates:
            for parts in (2, 3, 4):
                for mark, end in WRAPS.values():
                    body = wrap(t, parts, mark, end)
                    k, n = len(rows), body.count("\n")
                    rows.append((k, f"Some first line of text.{end}{mark}{end}{body}{end}{mark}{end}{mark}and a last one"))
                    expected.add((k, 2, 2 + n, family))
    got = {(r.doc_id, r.line, r.last_line, r.family) for r in L.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    lost, wrong = expected - got, got - expected
    assert not lost and not wrong, [(g, rows[g[0]][1]) for g in [*sorted(lost)[:4], *sorted(wrong)[:4]]]


def test_wrapped_headers_among_prose(spark, model):
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
    both = "Copyright 2020 A. Nobody. All rights\nreserved. Released under the MIT License."
    apart = "This program is free software: you can redistribute it and/or modify\n\nit under the terms of the GNU General Public License as published by"
    rows = [(1, f"Prose before it.\n{gpl}\nimport os"), (2, f"{bsd}\n{bsd}"), (3, both), (4, apart), (5, gpl.split("\n")[0]), (6, "the of\nunder the\n" * 20_000)]
    got = [(r.doc_id, r.line, r.last_line, r.family) for r in L.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    assert sorted(got) == [(1, 1, 3, "GPL"), (2, 0, 2, "BSD"), (2, 3, 5, "BSD"), (3, 0, 1, "reserved"), (3, 1, 1, "MIT")]
