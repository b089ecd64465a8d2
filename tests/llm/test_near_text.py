"""Near-duplicate texts against brute force over all pairs."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riverbend.llm import near_text
from riverbend.llm.common import split_words
from riverbend.llm.graph import components

SCHEMA = "doc_id long, text string, n long, digest string, rep long"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    """Component of every id by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in sets}


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rnd.choices(vocabulary, k=60))
    texts = []
    for _ in range(60):
        base = rnd.choices(vocabulary, k=rnd.choice([1, 3, 5, 30, 120, 400]))
        texts.append(" ".join(base))
        for _ in range(rnd.choice([0, 0, 1, 6])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, 4, 9])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
        if rnd.random() < 0.3:
            texts.append(passage + "\n" + " ".join(rnd.choices(vocabulary, k=200)))
    chain = rnd.choices(vocabulary, k=200)  # each near its neighbour only
    for step in range(12):
        texts.append(" ".join(chain))
        chain[step * 12:step * 12 + 12] = rnd.choices(vocabulary, k=12)
    texts += ["", " \n\t", "É one Two three four five", "É ONE two  three\tfour five", "é one two three four five"] * 2
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return [(i, t, 1, "x", 7) for i, t in zip(ids, texts, strict=True)]


def test_components_equal_brute_force(spark):
    rows = corpus() + [(90_000, None, None, None, None), (None, "a b c d e f", 1, "x", 1)]
    out = near_text.link_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute(rows)
    assert len(out) == len(rows)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == expected
    assert {r.doc_id: r.n_shingles for r in out} == {r[0]: len(shingles(r[1])) for r in rows}
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out)


def test_large_group_whose_members_are_not_all_alike(spark, monkeypatch):
    """Many copies that differ from one another, some beyond the threshold, and buckets of many chunks."""
    monkeypatch.setattr(near_text, "CHUNK", 3)
    rnd = random.Random(5)
    vocabulary = [f"v{k}" for k in range(3000)]
    hub = rnd.choices(vocabulary, k=150)
    rows = [(500, " ".join(hub))]
    for i in range(40):
        copy = list(hub)
        for at in rnd.sample(range(150), rnd.choice([1, 3, 3, 6, 9])):
            copy[at] = rnd.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    out = near_text.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == brute(rows)


def test_empty_table_and_repeated_rows(spark):
    assert near_text.link_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b c d e f", 1, "", 1)] * 3 + [(1, "q r s t u v", 1, "", 1), (2, "q r s t u v", 1, "", 1)]
    out = near_text.link_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 5 and {r.component_id for r in out} == {1}


def test_drop_copies_keeps_one_of_each_group(spark):
    rows = [(1, "a b c d e f", 1, "x", 1), (2, "A b c d e f", 2, "x", 1), (3, None, 3, "x", 1), (4, "", 4, "x", 1), (None, "a b c d e f", 5, "x", 1),
            (6, "q r s t u v", 6, "x", 1), (6, "q r s t u v", 6, "x", 1), (6, "other words of the same id", 7, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = near_text.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(r.n for r in out.collect()) == [1, 3, 4, 5, 6, 7]
    assert near_text.drop_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"t{k}" for k in range(60_000))
    rows = [(1, long), (2, long + " tail"), (3, "x" * 1_000_000)]
    out = {r.doc_id: r for r in near_text.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2].component_id == 1 and out[1].n_shingles == 59_996 and out[3].n_shingles == 1


def test_split_words_is_the_stated_pattern():
    texts = ["", None, " A B c\x0bd\x0ce\x1cf  ÀB\tz\r\n", "\x85x y İ"]
    flat, offsets = split_words(pa.array(texts).slice(0, 4))
    got = [flat[a:b].to_pylist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    pattern = re.compile(r"[^\x20\x09-\x0D]+")
    assert got == [pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]


@pytest.mark.parametrize("n,seed", [(60, 1), (300, 2)])
def test_components_of_random_graphs(spark, n, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(n * 2 // 3)] + [(k, k + 1) for k in range(1000, 1040)] + [(None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
