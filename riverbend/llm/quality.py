"""Document quality from weak labels.

Heuristic labellers vote good (1), bad (0) or nothing (2) on every document.  Expectation-maximisation finds how
often each labeller gives each vote on good and on bad documents, and the share of good ones, from how often every
pattern of votes occurs; so Spark only counts patterns (3 to the power of labellers at most) and no label is needed.  The
posterior chance of a document's pattern is its training label.  A logistic scorer over hashed features, word shapes
and pairs of neighbouring shapes, learns them on a bounded sample and then judges every document, also those on which
no labeller votes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, quoted, ship

FEATURES = 1 << 12
#: The scorer is fitted on so many different texts at most, drawn by their hash.
TRAIN_DOCS = 6000
#: Documents that score less are rejected.
LEAST = 0.5
TEXT_BYTES = 2 << 20

GOOD, BAD, NONE = 1, 0, 2
LONG = 1 << 62
#: Labeller: (statistic, good up to, bad from, fewest and most words).  Between the two, or on shorter or longer texts,
#: it doesn't vote; most labellers only know one fault and never vote good.
LABELLERS = (
    ("marks", None, 0.3, 1, LONG),  # words with a mark that isn't punctuation
    ("capitals", None, 0.5, 1, LONG),  # words in capitals
    ("bangs", None, 0.3, 1, LONG),  # words that end in two marks of exclamation
    ("bars", None, 0.15, 1, LONG),  # words that are a bar
    ("repeats", None, 0.25, 4, LONG),  # words equal to the one before
    ("sameness", 0.6, 0.8, 30, 500),  # words that stood before in the text
    ("odd", 0.1, 0.3, 1, LONG),  # words without digits that aren't letters and then one punctuation mark, or are in capitals
    ("run_on", 40, 120, 1, LONG),  # words for each that ends a sentence
)
MARK, CAPITAL, BANG, BAR, STOP, ODD = (1 << k for k in range(6))
_STRANGE = re.compile(r"[^\w\s.,;:!?'\"()|«»¿¡-]")
_RUN = re.compile(r"(.)\1+")


def _shape(word: str) -> str:
    """Runs of capitals, other letters and digits become A, a and 0; marks stay."""
    return _RUN.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))


@lru_cache(200_000)
def _look(word: str) -> tuple[int, int]:
    letters = sum(map(str.isalpha, word))
    capital = letters > 1 and word.isupper()
    odd = capital or not (word.isalpha() or word[:-1].isalpha() and word[-1] in ".,;:!?" or any(map(str.isdigit, word)))
    return zlib.crc32(_shape(word).encode()), (
        MARK * bool(_STRANGE.search(word)) | CAPITAL * capital | BANG * word.endswith("!!") | BAR * (word.strip("|") == "")
        | STOP * (word.rstrip("\"'»)")[-1:] in (".", "!", "?")) | ODD * odd)


_COMMON = {(form, end): _look(form + end) for form in ("a", "Aa") for end in ("", ".", ",")}


def _facts(word: str) -> tuple[int, int]:
    """A word's shape, hashed, and what labellers ask about it; plain words of one form are all alike."""
    end = word[-1] if word[-1] in ".," else ""
    body = word[:-1] if end else word
    if body.isalpha():
        if body.islower():
            return _COMMON["a", end]
        if body[1:].islower() and body[0].isupper():
            return _COMMON["Aa", end]
    return _look(word)


@dataclass
class Words:
    """Words of a batch by document: number of each among the distinct ones, hash of its shape, what it is."""

    offsets: np.ndarray
    number: np.ndarray
    shape: np.ndarray
    kind: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def read_words(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    coded = flat.filter(pa.array(full)).dictionary_encode()
    before = np.concatenate([[0], np.cumsum(full)])
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    facts = np.array([_facts(w) for w in coded.dictionary.to_pylist()], np.int64).reshape(-1, 2)[number]
    return Words(before[offsets - offsets[0]], number, facts[:, 0], facts[:, 1])


def votes(words: Words) -> np.ndarray:
    """Document, labeller: the vote."""
    doc, n_docs = words.doc, len(words.offsets) - 1
    n = np.diff(words.offsets)
    share = lambda flags: np.bincount(doc, flags, n_docs) / np.maximum(n, 1)
    stats = {name: share(words.kind & bit > 0) for name, bit in (("marks", MARK), ("capitals", CAPITAL), ("bangs", BANG), ("bars", BAR), ("odd", ODD))}
    again = (np.diff(words.number, prepend=-1) == 0) & (np.diff(doc, prepend=-1) == 0)
    stats["repeats"] = share(again)
    width = int(words.number.max(initial=0)) + 1
    stats["sameness"] = 1 - np.bincount(np.unique(doc * width + words.number) // width, minlength=n_docs) / np.maximum(n, 1)
    stats["run_on"] = n / np.maximum(np.bincount(doc, words.kind & STOP > 0, n_docs), 1)
    out = np.full((n_docs, len(LABELLERS)), NONE, np.int64)
    for k, (name, good, bad, least, most) in enumerate(LABELLERS):
        sized = (n >= least) & (n <= most)
        if good is not None:
            out[(stats[name] <= good) & sized, k] = GOOD
        out[(stats[name] >= bad) & sized, k] = BAD
    return out


def _pattern(vote: np.ndarray) -> np.ndarray:
    return vote @ 3 ** np.arange(len(LABELLERS))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, "text", TEXT_BYTES):
        words = read_words(batch.column("text"))
        patterns, n = np.unique(_pattern(votes(words))[np.diff(words.offsets) > 0], return_counts=True)
        yield pa.record_batch([pa.array(patterns), pa.array(n)], ["pattern", "n"])


@dataclass
class LabelModel:
    good: float  # share of good documents
    chance: np.ndarray  # class (bad, good), labeller, vote (bad, good, none)

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        """Chance that documents with these votes are good."""
        each = np.log(self.chance[GOOD] / self.chance[BAD])  # labeller, vote
        logit = np.log(self.good / (1 - self.good)) + each[np.arange(vote.shape[1]), vote].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def fit_labels(vote: np.ndarray, n: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns that occur ``n`` times each.

    Begins with every document bad that has a bad vote; half a vote of each kind is added to every count.
    """
    good = np.where((vote == BAD).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([n * (1 - good), n * good])
        total = weight.sum(axis=1) + 1.5
        chance = np.stack([((weight[:, :, None] * (vote == v)).sum(axis=1) + 0.5) / total[:, None] for v in (BAD, GOOD, NONE)], axis=2)
        model = LabelModel(float(total[GOOD] / total.sum()), chance)
        now = model.posterior(vote)
        done, good = np.abs(now - good).max(initial=0) < 1e-9, now
        if done:
            break
    return model


def features(words: Words) -> np.ndarray:
    """Document, hashed feature: root of the share of its words."""
    doc, n_docs = words.doc, len(words.offsets) - 1
    shape = words.shape
    same_doc = np.diff(doc, prepend=-1) == 0
    again = same_doc & (np.diff(words.number, prepend=-1) == 0)
    pair = (np.roll(shape, 1) * 31 + shape * 7 + again * 977)[same_doc]
    counts = np.bincount(doc * FEATURES + shape % FEATURES, minlength=n_docs * FEATURES)
    counts = counts + np.bincount(doc[same_doc] * FEATURES + (pair * 2654435761 >> 7) % FEATURES, minlength=n_docs * FEATURES)
    return np.sqrt(counts.reshape(n_docs, FEATURES) / np.maximum(np.diff(words.offsets), 1)[:, None]).astype(np.float32)


def _examples(labels: LabelModel):
    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text", TEXT_BYTES):
            words = read_words(batch.column("text"))
            full = np.diff(words.offsets) > 0
            good, table = labels.posterior(votes(words)), features(words)
            at = [np.flatnonzero(row) for row in table]
            yield pa.record_batch([pa.array(good[full]), batch.column("copies").filter(pa.array(full)), pa.array([a for a, f in zip(at, full, strict=True) if f], pa.list_(pa.int64())),
                                   pa.array([row[a] for row, a, f in zip(table, at, full, strict=True) if f], pa.list_(pa.float32()))], ["good", "copies", "at", "value"])
    return examples


@dataclass
class Scorer:
    weight: np.ndarray
    base: float

    def __call__(self, table: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(table @ self.weight + self.base, -500, 500)))


def fit_scorer(good: np.ndarray, copies: np.ndarray, rows: np.ndarray, at: np.ndarray, value: np.ndarray, steps: int = 300, decay: float = 1e-4) -> Scorer:
    """Logistic regression on posterior labels, both classes with equal total weight; Adam over the whole sample."""
    weight, base = np.zeros(FEATURES), 0.0
    if not len(good):
        return Scorer(weight, base)
    each = copies * (good / max(copies @ good, 1e-9) + (1 - good) / max(copies @ (1 - good), 1e-9))
    first, second = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for t in range(1, steps + 1):
        score = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weight[at] * value, len(good)) + base, -500, 500)))
        wrong = each * (score - good)
        slope = np.append(np.bincount(at, wrong[rows] * value, FEATURES) + decay * weight, wrong.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        move = 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
        weight, base = weight - move[:-1], base - move[-1]
    return Scorer(weight.astype(np.float32), float(base))


def train(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> tuple[LabelModel, Scorer]:
    """The label model over all texts, and the scorer on ``train_docs`` different texts at most, copies as weights."""
    ship(docs.sparkSession)
    base = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    counted = base.mapInArrow(_vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toArrow().combine_chunks()
    pattern, n = counted["pattern"].to_numpy(), counted["n"].to_numpy()
    labels = fit_labels(pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3, n)
    # each text once, with the number of its copies; of those drawn the ones with the least hashes
    share = int(min(1, 1.2 * train_docs / max(n.sum(), 1)) * (1 << 40)) + 1
    drawn = base.withColumn("h", F.xxhash64("text")).where(F.pmod(F.xxhash64("h"), F.lit(1 << 40)) < share)
    drawn = drawn.groupBy("h").agg(F.first("text").alias("text"), F.count("*").alias("copies")).orderBy("h").limit(train_docs)
    sample = drawn.mapInArrow(_examples(labels), "good double, copies long, at array<long>, value array<float>").toArrow().combine_chunks()
    at, value = sample["at"].combine_chunks(), sample["value"].combine_chunks()
    rows = np.repeat(np.arange(sample.num_rows), pc.list_value_length(at).to_numpy()) if sample.num_rows else np.zeros(0, np.int64)
    return labels, fit_scorer(sample["good"].to_numpy(), sample["copies"].to_numpy(), rows, at.flatten().to_numpy(), value.flatten().to_numpy())


def _score(scorer: Scorer):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for batch in cut(iter([pa.record_batch([texts], ["text"])]), "text", TEXT_BYTES):
            words = read_words(batch.column("text"))
            out.append(np.where(np.diff(words.offsets) > 0, scorer(features(words)), 0.0))
        return pa.array(np.concatenate(out), pa.float64())
    return score


def reject(docs: DataFrame, scorer: Scorer, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with the columns that they have."""
    ship(docs.sparkSession)
    return docs.where(_score(scorer)(F.col(text_col)) >= least)


def judge(docs: DataFrame, scorer: Scorer, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with columns ``quality_score`` (0 to 1, higher is better) and ``quality_kept``; columns of those names
    are replaced.

    A text that is null or has no word scores 0 and isn't kept.  Equal texts score alike whatever their row; an empty
    table gives an empty one.
    """
    ship(docs.sparkSession)
    names = [quoted(c) for c in docs.columns if c not in ("quality_score", "quality_kept")]
    scored = docs.select(*names, _score(scorer)(F.col(text_col)).alias("quality_score"))
    return scored.select(*names, "quality_score", (F.col("quality_score") >= least).alias("quality_kept"))
