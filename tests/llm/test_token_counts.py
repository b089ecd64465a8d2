"""Prefix counts against the library on every prefix, and whole texts of the sample table."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riverbend.llm import token_counts as C
from riverbend.sources.tables import read_table

from conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
WORDS = ["hello", "don't", "'re", "we'll!!", "Straße", "éàÜ", "$$$", "a1b22", "''s", "'llama", "!'s", "o'reilly's", "'lt", "日本語テキスト", "😀😀!", "İstanbul",
         "-" * 150, "éa", "thththereationing", " x y", "x ", "ﬁne", "Ǆ", "ª", "'ſ", "¡Hola!", "x" * 400, "ΑΣ", "a\x1cb", "&amp;&&%%%", "İs"]


@pytest.mark.parametrize("word", WORDS)
def test_every_prefix_of_a_piece(word):
    own = C.counter(PATH)
    steps = own.steps(word)
    counts = np.cumsum(np.frombuffer(steps, np.int8) if isinstance(steps, bytes) else steps)[:-1]
    text = own.library.normalizer.normalize_str(word)
    assert counts.tolist() == [len(own.library.encode(text[:k + 1], add_special_tokens=False).ids) for k in range(len(text))]


def test_special_strings():
    own = C.counter(PATH)
    for text in ("<|endoftext|>", "a<|endoftext|>b", "x!<|startoftext|><|endoftext|>", "<|endoftext", "<|ENDOFTEXT|>", "..<|endoftext|>'s"):
        steps = own.steps(text)
        counts = np.cumsum(np.frombuffer(steps, np.int8) if isinstance(steps, bytes) else steps)[:-1]
        assert counts.tolist() == [len(own.library.encode(text[:k + 1], add_special_tokens=False).ids) for k in range(len(text))], text


def test_full_tables_of_the_worker_start_anew(monkeypatch):
    own = C.PrefixCounter(PATH)
    expected = [own.steps(w) for w in ("alpha", "beta.", "gamma", "alpha")]
    for name in ("WORDS", "PIECES", "PAIRS"):
        monkeypatch.setattr(C, name, 1)
    fresh = C.PrefixCounter(PATH)
    assert [fresh.steps(w) for w in ("alpha", "beta.", "gamma", "alpha")] == expected


def test_whole_texts_budgets_and_odd_rows(spark):
    rows = [(k, w, "own", 1) for k, w in enumerate(WORDS)] + [(100, " ".join(WORDS * 3), "", 1), (101, None, "", 1), (102, "", "", 1), (103, " \n\t ", "", 1),
                                                         (None, "a b", "", 1), (0, "hello", "", 1), (104, "ab cd " * 60_000, "", 1)]
    table = C.prefix_table(spark.createDataFrame(rows, "doc_id long, text string, steps string, n_tokens int"), PATH)
    out = table.select("*", C.tokens_of_prefix("steps", 7).alias("seven"), C.chars_within("steps", 4).alias("cut")).collect()
    library = C.counter(PATH).library
    count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    by_text = {}
    for r, (i, text, *_) in zip(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        assert r.doc_id == i and r.n_bytes == len((text or "").encode()) and r.n_tokens == count(text or "")
        by_text[text] = r
    plain = " ".join(p for p in WORDS * 3 if p)
    r = by_text[plain]
    normal = " ".join(library.normalizer.normalize_str(p) for p in plain.split(" "))
    assert r.seven == count(normal[:7]) and count(normal[:r.cut]) <= 4 < count(normal[:r.cut + 1])
    assert by_text[None].seven == 0 and by_text[None].cut == 0
    assert C.prefix_table(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_sample_table_equals_library(spark):
    docs = read_table(spark, SF_SMALL, "documents", ["doc_id", "text"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.n_tokens for r in C.prefix_table(docs, PATH).select("doc_id", "n_tokens").where(F.col("doc_id").isNotNull()).collect()}
    encoded = C.counter(PATH).library.encode_batch([t or "" for t in texts.values()], add_special_tokens=False)
    assert got == {i: len(e.ids) for i, e in zip(texts, encoded, strict=True)}
