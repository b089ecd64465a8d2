"""Columns of any name and ids of any type, for every operator and stage that keeps or returns rows."""

import public_tokenizers
import pytest

import corpus_pipeline
from riverbend.llm import decontaminate, exact_text, language, licenses, line_chunks, mixing, near_text, near_vectors, periodic_runs, quality, token_alignment, token_counts

TEXT = "This is a plain sentence. And so is this other one here."
EXTRA = ["a.b", "row", "id", "key", "text_hash", "lines_removed", "quality_score", "quality_kept", "kept", "part", "n", "lines", "gone", "maybe", "sha"]
TYPES = ["short", "int", "long", "string", "decimal(12,0)", "date"]
BPE, PIECES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))


def _docs(spark, id_type="long"):
    value = "date_add(date'2024-01-01', i)" if id_type == "date" else f"cast(i AS {id_type})"
    text = f"CASE WHEN i = 3 THEN null WHEN i = 4 THEN '' WHEN i < 3 THEN '{TEXT}' ELSE concat('{TEXT} ', i) END"
    extra = ", ".join(f"concat('own ', i) AS `{c}`" for c in EXTRA)
    return spark.sql(f"SELECT {value} AS doc_id, {text} AS text, 'en' AS lang, 'src0' AS source, i AS n_chars, {extra} FROM (SELECT cast(id AS int) AS i FROM range(9))")


LABELLED = {
    "exact": exact_text.label_copies, "near": near_text.link_documents, "runs": periodic_runs.periodic_runs,
    "tokens": lambda d: token_counts.prefix_table(d, WORDS), "language": lambda d: language.predict(d, language.train(d)),
    "alignment": lambda d: token_alignment.align(d, BPE, PIECES).documents.withColumnRenamed("id", "doc_id"),
}


@pytest.mark.parametrize("name", sorted(LABELLED))
@pytest.mark.parametrize("id_type", TYPES)
def test_ids_of_any_type(spark, name, id_type):
    docs = _docs(spark, id_type)
    out = LABELLED[name](docs)
    assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_vectors_with_ids_of_any_type(spark):
    for id_type in TYPES[:5]:
        v = spark.sql(f"SELECT cast(id AS {id_type}) AS vec_id, array(1.0D, 0.0D, 0.5D) AS embedding, 1 AS label, 2 AS `a.b`, 3 AS rep FROM range(4)")
        assert {str(r.component_id) for r in near_vectors.link_vectors(v).collect()} == {"0"}


KEEPING = {
    "exact": exact_text.drop_copies, "near": near_text.drop_copies,
    "lines": lambda d: line_chunks.remove_repeats(d, removed_col="taken"),
    "leaks": lambda d: decontaminate.remove_leaks(d, d.limit(0).selectExpr("doc_id AS item_id", "text")),
    "quality": lambda d: quality.reject(d, quality.train(d)[1], least=0.0),
    "judge": lambda d: quality.judge(d, quality.train(d)[1]), "mix": mixing.mix_rows,
}


@pytest.mark.parametrize("name", sorted(KEEPING))
def test_rows_keep_their_columns(spark, name):
    docs = _docs(spark)
    own = {r.doc_id: r for r in docs.collect()}
    out = KEEPING[name](docs)
    replaced = {"judge": {"quality_score", "quality_kept"}, "mix": {"n_tokens", "domain", "epoch"}}.get(name, set())
    assert [c for c in out.columns if c not in replaced | {"taken"}] == [c for c in docs.columns if c not in replaced]
    rows = out.collect()
    assert rows and all(r[c] == own[r.doc_id][c] for r in rows for c in docs.columns if c not in replaced | {"text"})


def test_pipeline_stages_keep_columns_and_survive_small_and_empty_tables(spark):
    small = _docs(spark).where("doc_id in (1, 3, 4, 5)")
    for docs in (small, small.where("doc_id in (3, 4)"), small.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns[:len(columns)] == columns or name == "mix_sources"
            docs = spark.createDataFrame(out.collect(), out.schema)


def test_licences_with_any_id(spark):
    docs = _docs(spark, "short")
    assert licenses.find_licenses(docs, licenses.train(docs)).count() == 0
