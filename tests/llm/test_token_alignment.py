"""Alignment and counts against a plain version over the libraries, and the merge of runs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riverbend.llm import queries
from riverbend.llm import token_alignment as T
from riverbend.sources.tables import read_table

from conftest import SF_SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_chars():
    """The character of each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def brute(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    chars, texts, counts = byte_chars(), [], Counter()
    for _, text in rows:
        one = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        two = b.encode(text) if text else []
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in one]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in two]
        if {b"".join(bytes_a), b"".join(bytes_b)} != {(" " + (text or "")).encode()}:
            texts.append(([], [], [], []))
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        common = set(ends[0]) & set(ends[1])
        sides = []
        for ids, own in zip((one, two), ends, strict=True):
            groups = [[]]
            for i, e in zip(ids, own, strict=True):
                groups[-1].append(i)
                if e in common:
                    groups.append([])
            sides.append(groups[:-1])
        ended = {e: [j for j, f in zip(two, ends[1], strict=True) if f == e] for e in common}
        links = [(i, j) for i, e in zip(one, ends[0], strict=True) for j in ended.get(e, [])]
        texts.append((one, two, list(zip(*sides, strict=True)), links))
        counts.update(links)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for (i, _), (one, two, groups, links) in zip(rows, texts, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(one), len(two), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out, counts


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "  two  blanks ", "<|endoftext|> and </s><unk><0x41>", "naïve café ﬁne Ａ ½", "東京タワー 🙂🙂", "a\x00b", "\n\n\tx", "é ​",
       "▁ under", "x" * 3000, "the the the the", "the the the the"]


def test_query_equals_plain_version(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").limit(60).collect()]
    rows += [(9000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (9001, "the same id")]
    spark.createDataFrame([(i, t, 1, "own", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `row` int, groups string, `a.b` int").repartition(
        3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_token_alignment(spark, str(tmp_path))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows)[0], key=repr)


# spills of a few links, and many merges of one bucket
@pytest.mark.parametrize("run_records, merge_records", [(50, 100), (1 << 20, 1 << 22)])
def test_pairs_and_contributions(spark, run_records, merge_records):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choice(["the", "cat", "naïve", "of", "antidisestablishment", ",", "."]) for _ in range(rnd.randrange(40)))) for k in range(80)]
    found = T.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), A, B, run_records=run_records, merge_records=merge_records)
    expected, counts = brute(rows)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    assert {(r.a_id, r.b_id): (r.n, r.is_best) for r in found.pairs.collect()} == {p: (n, n == most[p[1]]) for p, n in counts.items()}
    rows_of = {r.row: r.id for r in found.documents.collect()}
    got = {rows_of[r.row]: (r.n_best, r.count_sum) for r in found.contributions.collect()}
    assert got == {e[0]: e[5:7] for e in expected if e[4]}


def test_merge_is_in_order_and_whole(monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 7)
    rng = np.random.default_rng(3)
    runs, all_records = [], Counter()
    for k in range(9):
        keys = np.sort(rng.integers(0, 40, rng.integers(0, 200)) << int(rng.integers(0, 2)) * 33)
        rows, times = rng.integers(0, 5, len(keys)) + (k << 40), rng.integers(1, 4, len(keys))
        all_records.update(zip(keys.tolist(), rows.tolist(), times.tolist(), strict=True))
        runs.append(T.write_run(keys, rows, times))
    got, last = Counter(), -1
    for keys, rows, times in T.merge(runs):
        assert keys[0] > last and (np.diff(keys) >= 0).all()
        last = keys[-1]
        got.update(zip(keys.tolist(), rows.tolist(), times.tolist(), strict=True))
    assert got == all_records and list(T.merge([])) == []


def test_pieces_give_what_whole_texts_give():
    own, rnd = T.tokens(A, B), random.Random(9)
    parts = ["the", "cat", "don't", "naïve", "Ünder", "ﬁne", "½", "東京", "🙂", "\u0301x", "\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", "\n", "\t", "  ", " ", "",
             "a.b", "<|endoftext|>", "</s>", "12", "_", "▁", "\u0370Ω", "ж", "\u07ff", "́", "x\u200b", "'s", "…", "`", "´", "¨"]
    texts = [rnd.choice([" ", "", " "]).join(rnd.choice(parts) for _ in range(rnd.randrange(25))) for _ in range(1500)] + [None, *ODD]
    texts += [r + " " + "x" for r in parts] + ["x " + r for r in parts]
    array = pa.array(texts)
    for some in (array, array.slice(700, 40), array[:0]):
        one, two = T.align_batch(own, some), T.align_texts(own, [t or "" for t in some.to_pylist()])
        assert [x.tolist() for x in one[:3]] == [x.tolist() for x in two[:3]] and one.groups.to_pylist() == two.groups.to_pylist()
        links = lambda g: sorted(zip(g.text.tolist(), g.a.tolist(), g.b.tolist(), strict=True))
        assert links(one) == links(two)
    flat, offsets = T.pieces(pa.array(["a b  c", "", " d e ", None, "f"]))
    assert flat.to_pylist() == ["a", "b  c", " d", "e ", "f"] and offsets.tolist() == [0, 2, 2, 4, 4, 5]


def test_every_token_has_bytes():
    own = T.tokens(A, B)
    assert own.cut
    assert own.of_a.size.min() > 0 and own.of_b.size.min() > 0


def test_empty_table_and_other_ids(spark):
    found = T.align(spark.createDataFrame([], "doc_id string, text string"), A, B)
    assert [d.count() for d in found] == [0, 0, 0]
    named = T.align(spark.createDataFrame([("x", "one two")], "name string, body string"), A, B, "name", "body")
    assert [(r.id, r.n_links) for r in named.documents.collect()] == [("x", 2)]
