"""Registered queries against their SQL on the smallest tables, and the pipeline against its stages' plain rules."""

import duckdb
import pytest

import corpus_pipeline
from riverbend.llm import decontaminate
from riverbend.llm.oracle import ORACLE
from riverbend.llm.queries import QUERIES
from riverbend.sources.tables import TABLES, read_table, table_path

from conftest import SF_SMALL
from test_entry import rows_key


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    columns, rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(columns, rows)


def test_pipeline_stages(spark):
    from .test_line_chunks import brute as plain_lines
    from .test_near_text import brute as plain_components

    docs = read_table(spark, SF_SMALL, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF_SMALL)
        rows = out.collect()
        if name != "mix_sources":
            assert out.columns == docs.columns, name
        ids = {r.doc_id for r in rows}
        assert ids <= set(before), name
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in read_table(spark, SF_SMALL, "labels").collect()}
            bad, good = [i for i, q in labels.items() if q == 0], [i for i, q in labels.items() if q == 1]
            assert len(ids & set(good)) >= 0.97 * len(good) and len(ids & set(bad)) <= 0.1 * len(bad) + 1
        if name == "line_dedup":
            assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((i, t) for i, t, _ in plain_lines([(i, r.text) for i, r in before.items()])), key=repr)
            assert all(r.n_chars == len(r.text) for r in rows if r.text != before[r.doc_id].text)
        if name == "near_dedup":
            components = plain_components([(i, r.text) for i, r in before.items()])
            assert ids == {i for i, c in components.items() if i == c}
        if name == "decontamination":
            leaks = {r.doc_id for r in decontaminate.find_leaks(kept, read_table(spark, SF_SMALL, "benchmark")).collect()}
            assert ids == set(before) - leaks
        if name == "mix_sources":
            assert out.columns == [*docs.columns, "domain", "n_tokens", "epoch"] and rows
        before = {r.doc_id: r for r in rows}
        kept = spark.createDataFrame(rows, out.schema)
