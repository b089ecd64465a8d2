"""Runs against a plain search of all lags, and the query's digests against their definition."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from riverbend.llm import periodic_runs as R
from riverbend.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs of a list by their definition: maximal stretches of every lag, each with its smallest period."""
    out, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def runs_of(texts):
    """By the operator, all texts in one batch."""
    flat = [w for t in texts for w in t]
    number = {w: k for k, w in enumerate(dict.fromkeys(flat))}
    offsets = np.cumsum([0] + [len(t) for t in texts])
    found = R.find_runs(np.array([number[w] for w in flat], np.int64), offsets)
    return [[tuple(int(v) for v in r[1:]) for r in found if r[0] == k] for k in range(len(texts))]


def planted(rnd, n, vocabulary):
    words = [str(rnd.randrange(vocabulary)) for _ in range(n)]
    for _ in range(rnd.randrange(4) if n else 0):
        q, at = rnd.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 40, 64, 100]), rnd.randrange(n)
        unit = [str(rnd.randrange(vocabulary)) for _ in range(q)]
        long = rnd.randrange(max(1, 2 * q - 2), 5 * q + 14)
        words[at:at + long] = (unit * (long // q + 1))[:long]
    return words


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 10, 100, 5000])
def test_equals_search_of_all_lags(vocabulary):
    rnd = random.Random(vocabulary)
    texts = [planted(rnd, rnd.choice([1, 5, 11, 12, 13, 40, 200, 500]), vocabulary) for _ in range(60)] + [[], ["a"] * 12, ["a"] * 11, list("ab") * 6, list("abcdef") * 2]
    assert runs_of(texts) == [brute(t) for t in texts]


def test_structured_sequences():
    fib, thue = ["a", "ab"], "a"
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    for _ in range(10):
        thue += thue.translate(str.maketrans("ab", "ba"))
    blocks = list(("a" * 30 + "b") * 9 + "ab" * 20 + "ababa" * 4 + "c" + "ababa" * 3)
    texts = [list(fib[-1]), list(thue), blocks, list("ruler") * 3, [str((k & -k).bit_length()) for k in range(1, 700)]]
    assert runs_of(texts) == [brute(t) for t in texts]


def test_steps_may_cut_anywhere(monkeypatch):
    rnd = random.Random(8)
    texts = [planted(rnd, 400, v) for v in (2, 5, 50) for _ in range(6)] + [["a", "b", "c"] * 200, list("abcdefghijklmnop" * 30)]
    monkeypatch.setattr(R, "STEP", 64)
    assert runs_of(texts) == [brute(t) for t in texts]


def test_splitting_leaves_little_of_prose_and_all_of_runs():
    rnd = random.Random(4)
    prose = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(20_000)]
    number = {w: k for k, w in enumerate(dict.fromkeys(prose))}
    ids = np.array([number[w] for w in prose], np.int64)
    ids[5000:5060] = ids[4940:5000]
    at, segment = R.segments(ids, np.zeros(len(ids), np.int64))
    assert set(range(4940, 5060)) <= set(at.tolist())
    assert all(np.diff(at[segment == s]).max() == 1 for s in np.unique(segment))


def test_long_texts_of_few_words_are_fast():
    rnd = random.Random(6)
    begin = time.time()
    texts = [["x"] * 300_000, [str(rnd.randrange(2)) for _ in range(300_000)], [str(k % 7001) for k in range(300_000)]]
    one, _, three = runs_of(texts)
    assert one == [(0, 300_000, 1)] and three == [(0, 300_000, 7001)] and time.time() - begin < 60


def rewritten(doc_id, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = rewritten(doc_id, text)
    runs = brute(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_definition(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(k, rnd.choice([" ", "\n", " \t\r\x0b\x0c "]).join(planted(rnd, rnd.choice([0, 3, 20, 150, 300]), rnd.choice([3, 30, 3000])) or [""])) for k in range(150)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "É É É x " * 9), (504, "a " * 40), (504, "a " * 40), (None, "b c " * 30), (None, None)]
    spark.createDataFrame([(i, t, "own", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, runs string, `a.b` int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(*r) for r in rows), key=repr)


def test_empty_table(spark):
    assert R.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
