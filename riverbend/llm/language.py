"""Language of texts that may mix languages.

A word is a run of letters, lower-cased.  Its features are the character trigrams around each of its letters, a word's
edge being a character of its own; a language's score of a word is the sum of their smoothed log probabilities.  The
script of a word's letters narrows the languages that may claim it to those that use the script.  Viterbi then labels
all words of a text: the path with the greatest sum of word scores less ``PENALTY`` for each change of language.  Runs
of one label are the spans, and the language with most letters is the text's.

The model is a table of trigram counts per language, hashed into ``BUCKETS``; it is summed by Spark and only the sums,
of a size fixed by ``BUCKETS`` and the number of languages, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

BUCKETS = 1 << 16
#: Nats that a change of language costs.
PENALTY = 12.0
SMOOTHING = 0.5
#: A language uses a script if that share of its training letters is in it.
USES_SCRIPT = 0.01
#: The model is fitted on about so many labelled documents of each language, drawn by a hash of their text.
TRAIN_DOCS = 4000
TEXT_BYTES = 4 << 20

#: The main ranges of letters of some scripts (first, last); other letters are script 0.
SCRIPTS = (
    (0x0041, 0x024F), (0x1E00, 0x1EFF),  # Latin
    (0x0370, 0x03FF), (0x1F00, 0x1FFF),  # Greek
    (0x0400, 0x052F),  # Cyrillic
    (0x0530, 0x058F),  # Armenian
    (0x0590, 0x05FF),  # Hebrew
    (0x0600, 0x06FF), (0x0750, 0x077F),  # Arabic
    (0x0900, 0x097F),  # Devanagari
    (0x0980, 0x09FF),  # Bengali
    (0x0E00, 0x0E7F),  # Thai
    (0x10A0, 0x10FF),  # Georgian
    (0x1100, 0x11FF), (0xAC00, 0xD7AF),  # Hangul
    (0x3040, 0x30FF),  # Kana
    (0x4E00, 0x9FFF), (0x3400, 0x4DBF),  # Han
)
SCRIPT_OF_RANGE = (1, 1, 2, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10, 11, 11, 12, 13, 13)
N_SCRIPTS = 14


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, its lower case if that is one code point, its script."""
    points = [chr(c) for c in range(0x110000)]
    letter = np.fromiter((c.isalpha() for c in points), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(letter):
        if len(low := points[c].lower()) == 1:
            lower[c] = ord(low)
    script = np.zeros(0x110000, np.uint8)
    for (first, last), number in zip(SCRIPTS, SCRIPT_OF_RANGE, strict=True):
        script[first:last + 1] = number
    return letter, lower, script


@dataclass
class Words:
    """All words of a batch: document, first and last position within its text, script, letters' trigram buckets."""

    doc: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    at: np.ndarray  # a word's first entry in grams


def read_words(texts: list[str | None]) -> Words:
    letter, lower, script = _tables()
    size = np.array([len(t or "") + 1 for t in texts], np.int64)
    codes = lower[np.frombuffer("".join(f"{t or ''}\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    is_letter = letter[codes]
    edge = np.flatnonzero(np.diff(is_letter, prepend=False, append=False))
    first, stop = edge[::2], edge[1::2]
    start = np.cumsum(size) - size
    doc = np.searchsorted(start, first, side="right") - 1
    shown = np.where(is_letter, codes, 0).astype(np.uint64)
    at = np.flatnonzero(is_letter)
    # the text's last character is a line feed, so both neighbours are there
    h = (np.roll(shown, 1)[at] * np.uint64(0x9E3779B97F4A7C15)) ^ (shown[at] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (shown[(at + 1) % len(shown)] * np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    grams = (h >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    n = stop - first
    return Words(doc, first - start[doc], stop - start[doc], script[codes[first]], grams, np.cumsum(n) - n)


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # bucket, language
    scripts: np.ndarray  # script, language: whether the language uses it

    def scores(self, words: Words) -> np.ndarray:
        """Word, language: the score, minus infinity where the script rules the language out.  A script that no
        language uses tells nothing."""
        out = np.add.reduceat(self.logs[words.grams], words.at, axis=0).astype(np.float64)
        allowed = self.scripts[words.script]
        known = allowed.any(axis=1)
        out[~known] = 0
        out[known[:, None] & ~allowed] = -np.inf
        return out

    def label(self, words: Words, n_docs: int) -> np.ndarray:
        """The language of each word on its text's best path; all texts of the batch advance together."""
        scores = self.scores(words)
        n, width = scores.shape
        length = np.bincount(words.doc, minlength=n_docs)
        order = np.argsort(-length, kind="stable")
        start = (np.cumsum(length) - length)[order]
        longest = int(length.max(initial=0))
        active = np.searchsorted(-length[order], -np.arange(longest), side="left")  # texts longer than t
        changed, best = np.zeros((n, width), bool), np.zeros(n, np.int64)
        at = start[:active[0]]
        total = scores[at]
        for t in range(longest):
            if t:
                at = start[:active[t]] + t
                total = total[:active[t]]
                top = total.max(axis=1, keepdims=True) - PENALTY
                changed[at] = total < top
                total = np.maximum(total, top) + scores[at]
            best[at] = total.argmax(axis=1)
        out = np.empty(n, np.int64)
        last = start[:active[0]] + length[order][:active[0]] - 1
        out[last] = best[last]
        for t in range(longest - 1, 0, -1):
            at = start[:active[t]] + t
            now = out[at]
            before = np.where(changed[at, now], best[at - 1], now)
            out[at - 1] = before
        return out


def _trigram_counts(languages: list[str]):
    number = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text", TEXT_BYTES):
            words = read_words(batch.column("text").to_pylist())
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)[words.doc]
            n = words.stop - words.first
            keys, counts = np.unique(np.repeat(lang, n) * BUCKETS + words.grams, return_counts=True)
            scripts = np.bincount(lang * N_SCRIPTS + words.script, n, len(languages) * N_SCRIPTS).astype(np.int64)
            used = np.flatnonzero(scripts)
            yield pa.record_batch([
                pa.array(np.concatenate([keys // BUCKETS, used // N_SCRIPTS])),
                pa.array(np.concatenate([keys % BUCKETS, BUCKETS + used % N_SCRIPTS])),
                pa.array(np.concatenate([counts, scripts[used]]))], ["lang", "item", "n"])
    return count


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", docs_each: int = TRAIN_DOCS) -> Model:
    """Fit on the rows of ``labelled`` whose text and language aren't null: about ``docs_each`` of each language."""
    ship(labelled.sparkSession)
    base = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in base.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    logs, scripts = np.zeros((BUCKETS, len(languages)), np.float32), np.zeros((N_SCRIPTS, len(languages)), bool)
    if not languages:
        return Model(languages, logs, scripts)
    share = F.lit(0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, int(min(1, docs_each / n) * (1 << 20)) + 1).otherwise(share)
    drawn = base.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share)
    counted = drawn.mapInArrow(_trigram_counts(languages), "lang long, item long, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    rows = counted.toArrow().combine_chunks()
    lang, item, n = (rows[c].to_numpy() for c in ("lang", "item", "n"))
    gram = item < BUCKETS
    counts = np.zeros((BUCKETS, len(languages)))
    counts[item[gram], lang[gram]] = n[gram]
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)
    letters = np.zeros((N_SCRIPTS, len(languages)))
    letters[item[~gram] - BUCKETS, lang[~gram]] = n[~gram]
    scripts = letters > USES_SCRIPT * np.maximum(letters.sum(axis=0), 1)
    return Model(languages, logs, scripts)


def _predict(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = max(len(model.languages), 1)
        for batch in cut(batches, "text", TEXT_BYTES):
            words = read_words(batch.column("text").to_pylist())
            n = batch.num_rows
            pred, score = np.array(["und"] * n, object), np.zeros(n)
            spans: list[list[dict]] = [[] for _ in range(n)]
            if len(words.doc) and model.languages:
                label = model.label(words, n)
                size = words.stop - words.first
                told = size * model.scripts[words.script].any(axis=1)  # other scripts' letters speak for no language
                letters = np.bincount(words.doc * width + label, told, n * width).reshape(n, width)
                total = np.bincount(words.doc, size, n)
                seen = total > 0
                pred[seen] = np.array(model.languages, object)[letters.argmax(axis=1)][seen]
                score[seen] = letters.max(axis=1)[seen] / total[seen]
                new = np.flatnonzero((np.diff(words.doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
                for a, b in zip(new, [*new[1:], len(label)], strict=True):
                    spans[words.doc[a]].append({"start": int(words.first[a]), "stop": int(words.stop[b - 1]), "lang": model.languages[label[a]]})
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))
            yield pa.record_batch([batch.column("id"), pa.array(pred, pa.string()), pa.array(score), pa.array(spans, span)],
                                  ["id", "lang_pred", "score", "spans"])
    return predict


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row.

    ``score`` is the share of the text's letters in words of the predicted language, without words of a script that no
    language uses (0 where there are no others); ``spans`` are (start, stop, lang)
    of its runs of one language, in code points of the text.  A text that is null or has no letter is ``und`` with
    score 0 and no span, and so is every text if the model has learned no language.  Of equal languages the first by
    name wins.  Null and repeated ids are kept; an empty table gives an empty one; other columns are not read.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, lang_pred string, score double, spans array<struct<start: long, stop: long, lang: string>>"
    return base.mapInArrow(_predict(model), schema).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of training: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
