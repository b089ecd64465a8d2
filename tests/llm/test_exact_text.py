"""Exact copies against a plain version, with filters of any size."""

import hashlib
import random
import re

import numpy as np
import pytest

from riverbend.llm import common as C
from riverbend.llm import exact_text as E

SCHEMA = "doc_id long, text string, sha string, `a.b` int, kept string"


def plain(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(plain(t), []).append((i is not None, i or 0, k))
    out = []
    for i, t in rows:
        g = groups[plain(t)]
        has, keep, _ = max(g)
        out.append((i, keep if has else None, len(g), hashlib.sha256(plain(t).encode()).hexdigest()))
    return out


def sample():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("ab AB é É İ ß x y".split(" ")) for _ in range(rnd.choice([0, 1, 2, 3, 12]))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000 + k, "THE hot Text") for k in range(150)] + [(2000, None), (2001, ""), (2002, " "), (2003, "\n")]
    rows += [(None, "the hot text"), (None, "only nulls"), (None, "ONLY nulls"), (1149, "the hot text"), (3000, "x" * 2_000_000), (3001, "X" * 2_000_000)]
    rnd.shuffle(rows)
    return rows


# the filter's errors change what is shuffled, not the result
@pytest.mark.parametrize("bits, keys, part", [(1 << 20, 1 << 18, 1 << 20), (64, 1 << 18, 20), (1 << 12, 40, 7)])
def test_equals_plain_version(spark, bits, keys, part):
    rows = sample()
    df = spark.createDataFrame([(i, t, "own", k, "no") for k, (i, t) in enumerate(rows)], SCHEMA).repartition(5)
    out = E.label_copies(df, filter_bits=bits, shard_keys=keys, part_rows=part)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = out.collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r[:3]) + r[3:]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(brute(rows), key=key)
    stays = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in stays) and sorted(r.text_sha256 for r in stays) == sorted({b[3] for b in brute(rows)})

    kept = E.drop_copies(df, filter_bits=bits, shard_keys=keys)
    assert kept.columns == df.columns
    by_row = {k: b for k, b in enumerate(brute(rows))}
    left = kept.collect()
    assert len(left) == len(stays) and {r.sha for r in left} == {"own"} and {r.kept for r in left} == {"no"}
    assert len({by_row[r["a.b"]][3] for r in left}) == len(left)
    assert all(by_row[r["a.b"]][:2] == (r.doc_id, r.doc_id) and rows[r["a.b"]][1] == r.text for r in left)


def test_most_rows_are_not_shuffled(spark):
    rows = [(k, f"text {k}") for k in range(5000)] + [(9000 + k, f"text {k}") for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    maybe, n = E._filtered(df, "text", C.FILTER_BITS, E.SHARD_KEYS)
    assert n == 5050 and 100 <= df.where(maybe).count() <= 130


def test_filter_keeps_what_it_knows_and_little_else():
    rng = np.random.default_rng(1)
    own, other = (rng.integers(0, 1 << 63, 50_000).astype(np.uint64) for _ in range(2))
    for most_bits, errors in ((1 << 29, 10), (1 << 18, 25_000)):
        f = C.HashFilter(len(own), most_bits, 1 << 13)
        f.bits = np.concatenate([np.frombuffer(f.slice_of(own[f.shard(own) == s]), np.uint8) for s in range(f.shards)])
        assert len(f.bits) * 8 <= most_bits and f.maybe(own).all() and f.maybe(other).sum() <= errors


def test_empty_table_and_other_ids(spark):
    assert E.label_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    assert E.drop_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([("b", "x"), ("a", "X"), ("c", None)], "name string, body string")
    assert sorted((r.name, r.keep_id, r.kept) for r in E.label_copies(df, "name", "body").collect()) == [
        ("a", "b", False), ("b", "b", True), ("c", "c", True)]
