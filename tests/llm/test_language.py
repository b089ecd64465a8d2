"""Viterbi against all paths, spans of mixed texts, held-out accuracy."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from riverbend.llm import language as L
from riverbend.sources.tables import read_table

from conftest import SF_MID

EN = "the quick brown fox jumps over the lazy dog and then the other animals were thinking about what they should have done with this weather"
DE = "der schnelle braune Fuchs springt über den faulen Hund und danach haben die anderen Tiere überlegt was sie bei diesem Wetter machen sollten"
RU = "быстрая лиса прыгает через ленивую собаку и потом другие звери думали что им делать в такую погоду"


def model(spark):
    rows = [(EN, "en"), (DE, "de"), (RU, "ru")] * 3 + [(None, "fr"), ("sans langue", None)]
    return L.train(spark.createDataFrame(rows, "text string, lang string"))


def test_label_is_the_best_of_all_paths(spark):
    m = model(spark)
    texts = ["the dog und собака 東京", "über", "", "what wetter", "fox Fuchs fox der the " * 1, "1 2 3"]
    words = L.read_words(texts)
    got, scores = m.label(words, len(texts)), m.scores(words)
    value = lambda path, own: sum(s[p] for s, p in zip(own, path, strict=True)) - L.PENALTY * sum(a != b for a, b in itertools.pairwise(path))
    for d in range(len(texts)):
        own, path = scores[words.doc == d], got[words.doc == d]
        if len(own):
            best = max(value(p, own) for p in itertools.product(range(len(m.languages)), repeat=len(own)))
            assert np.isclose(value(path, own), best)


def test_spans_scripts_and_odd_rows(spark):
    m = model(spark)
    assert m.languages == ["de", "en", "ru"]
    mixed = f"{EN}. {DE}! {RU}"
    rows = [(1, mixed), (2, EN), (3, None), (4, "12 34 !!"), (5, ""), (6, "東京タワー"), (None, DE), (2, EN), (7, "İ" + DE), (8, (DE + " ") * 2000)]
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], "doc_id long, text string, lang_pred string, score double")
    out = L.predict(df, m).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    spans = [(s.lang, mixed[s.start:s.stop]) for s in by[1].spans]
    assert spans == [("en", EN), ("de", DE), ("ru", RU)] and by[1].lang_pred == "de" and 0 < by[1].score < 1
    assert (by[2].lang_pred, by[2].score, by[None].lang_pred, by[8].lang_pred) == ("en", 1.0, "de", "de")
    for k in (3, 4, 5):
        assert (by[k].lang_pred, by[k].score, by[k].spans) == ("und", 0.0, [])
    assert by[6].lang_pred in m.languages  # letters of a script that no language uses tell nothing
    assert [r.lang_pred for r in L.predict(df.where("doc_id = 2"), L.train(df.where("false").withColumn("lang", F.lit("x")))).collect()] == ["und"] * 2
    assert L.predict(df.where("false"), m).count() == 0


def test_held_out_accuracy(spark):
    docs = read_table(spark, SF_MID, "documents", ["doc_id", "text", "lang"])
    m = L.train(docs.where(~L.held_out()))
    joined = L.predict(docs, m).join(docs.where(L.held_out()).select("doc_id", "lang"), "doc_id")
    r = joined.agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first()
    assert r.n > 100 and r.right >= 0.95


def test_scripts_of_no_language_give_no_certainty(spark):
    docs = [(k, "the cat sat on the mat and the dog" if k % 2 else "der hund und die katze sind hier", "en" if k % 2 else "de") for k in range(40)]
    model = L.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    rows = [(1, "東京タワー"), (2, "the cat 東京タワ and the dog")]
    got = {r.doc_id: r for r in L.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1].lang_pred in ("de", "en") and got[1].score == 0
    assert got[2].lang_pred == "en" and 0 < got[2].score < 0.8
