"""The label model on simulated votes, the scorer on labelled documents."""

import numpy as np
import pyarrow as pa

from riverbend.llm import quality as Q
from riverbend.sources.tables import read_table

from conftest import SF_MID


def test_label_model_finds_the_labellers():
    rnd = np.random.default_rng(2)
    good = rnd.random(20_000) < 0.8
    draw = lambda share: rnd.random(len(good)) < share
    vote = np.full((len(good), 4), Q.NONE)
    vote[~good & draw(0.5), 0] = Q.BAD  # finds half of the bad ones, never wrong
    vote[:, 1] = np.where(np.where(good, draw(0.03), draw(0.7)), Q.BAD, Q.GOOD)  # seldom wrong on good ones
    vote[draw(0.5), 1] = Q.NONE
    vote[draw(0.04), 2] = Q.BAD  # chance
    vote[:, 3] = np.where(np.where(good, draw(0.02), draw(0.6)), Q.BAD, Q.GOOD)
    patterns, n = np.unique(vote, axis=0, return_counts=True)
    model = Q.fit_labels(patterns, n)
    ratio = model.chance[Q.BAD, :, Q.BAD] / model.chance[Q.GOOD, :, Q.BAD]
    assert ratio[0] > 20 and ratio[1] > 5 and ratio[3] > 5 and ratio[2] < 2.5
    assert 0.7 < model.good < 0.9 and ((model.posterior(vote) >= 0.5) == good).mean() > 0.93


def test_votes_of_plain_texts():
    texts = ["This is a plain sentence. And so is this one.", "BUY!! NOW!! CHEAP!! THINGS!!", "a*** b$$$ c%%% d###", "word | word | word | word |",
             "la la la la la la la la", None, "", "Mail me at x.y@z.org or call 555 01 02."]
    vote = Q.votes(Q.read_words(pa.array(texts)))
    name = [x[0] for x in Q.LABELLERS]
    assert (vote[0] != Q.BAD).all() and (vote[7] != Q.BAD).all()
    for row, faults in ((1, ("capitals", "bangs")), (2, ("marks",)), (3, ("bars",)), (4, ("repeats",))):
        assert all(vote[row, name.index(f)] == Q.BAD for f in faults), faults


def test_scorer_keeps_good_documents_and_rejects_bad_ones(spark):
    docs = read_table(spark, SF_MID, "documents")
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_MID, "labels").collect()}
    _, scorer = Q.train(docs)
    out = {r.doc_id: r.quality_kept for r in Q.judge(docs, scorer).collect()}
    kept = {q: np.mean([out[i] for i, x in labels.items() if x == q and i in out]) for q in (0, 1)}
    assert kept[1] >= 0.98 and kept[0] <= 0.05, kept


def test_odd_rows(spark):
    rows = [(1, None, "a", 1.0), (2, "", "b", 1.0), (3, " \n", "c", 1.0), (None, "A fine sentence. Another one follows it.", "d", 1.0)] * 2
    rows += [(k, f"Some words make a sentence {k}. It ends here.", "e", 1.0) for k in range(30)] + [(99, "word " * 200_000, "f", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good string, quality_score double")
    _, scorer = Q.train(df)
    out = Q.judge(df, scorer)
    assert out.columns == ["doc_id", "text", "good", "quality_score", "quality_kept"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.quality_score <= 1 for r in got)
    assert all((r.quality_score, r.quality_kept) == (0.0, False) for r in got if r.doc_id in (1, 2, 3) and r.good in "abc")
    empty = df.where("false")
    assert Q.judge(empty, Q.train(empty)[1]).count() == 0
