"""Vector links against brute force in double precision."""

import numpy as np
import pytest

from riverbend.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n long, digest string"


def brute(rows):
    usable = []
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            x = np.array(v, np.float32).astype(np.float64)
            if np.linalg.norm(x) > 0:
                usable.append((i, x / np.linalg.norm(x), label))
    links = {i: 0 for i, *_ in rows}
    parent = {i: i for i, *_ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x, p) in enumerate(usable):
        for j, y, q in usable[:k]:
            if p == q and len(x) == len(y) and x @ y >= near_vectors.MIN_COSINE:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (links[i], root(i)) for i in links}


def vectors(seed, n, dim):
    rnd = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = rnd.standard_normal(dim)
        out.append(base)
        for _ in range(rnd.choice([0, 0, 1, 8])):
            out.append(base + rnd.standard_normal(dim) * rnd.choice([0, 0.1, 0.25, 0.37, 0.5]))
    return [(k, [float(x) for x in np.float32(v)], int(rnd.choice([0, 0, 1])), 1, "x") for k, v in enumerate(out[:n])]


@pytest.mark.parametrize("dim,chunk", [(64, 4096), (64, 7), (13, 4096), (3, 5)])
def test_links_equal_brute_force(spark, monkeypatch, dim, chunk):
    monkeypatch.setattr(near_vectors, "CHUNK", chunk)
    rows = vectors(dim + chunk, 250, dim)
    out = near_vectors.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_odd_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 1), (2, one, None), (3, None, 1), (4, [0.0] * 3, 1), (5, [1.0, None, 0.0], 1), (6, [float("nan"), 1.0, 0.0], 1),
            (7, [float("inf"), 0.0, 0.0], 1), (8, [], 1), (9, [2.0, 0.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, -0.0, 0.0], 1), (12, one, 2)]
    rows = [(*r, 1, "x") for r in rows]
    out = near_vectors.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == brute(rows)
    assert {r.vec_id for r in out if r.n_links} == {1, 9, 11}
    none = near_vectors.link_vectors(spark.createDataFrame([(None, one, 1, 1, "x")] * 2, SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in none] == [(None, 0, None, True)] * 2


def test_empty_table_and_copies(spark):
    assert near_vectors.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(k, [0.5, 0.25, -1.0], 3, 1, "x") for k in range(500)] + [(7, [0.5, 0.26, -1.0], 3, 1, "x")]
    out = near_vectors.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 501 and {(r.n_links, r.component_id) for r in out} == {(500, 0)}
