"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits, lower-cased.  A mask is a window of word positions of which only the marked
ones are hashed, so a substituted word under an unmarked position doesn't hide a hit.  An item shorter than the first
mask is one window of its own length.  Windows of the benchmark and of the documents under all masks are joined on
their hashes.  A hit sets a document against an item at one offset; the words of both are then compared along the whole
item at that offset.  The document is contaminated by the item when the longest-scoring stretch (+1 for an equal word,
``PENALTY`` for another) has at least ``MIN_EQUAL`` equal words, or all of a shorter item, and they are ``MIN_SHARE`` of
the item's words, or has ``LONG_EQUAL`` equal words whatever the item's length.  Where no offset does, hits of the item at
offsets at most ``BAND`` apart are put together: the item is aligned to the document over these offsets and ``BAND`` more
on either side, an inserted or dropped word costs as much as another word, and the best stretch must pass the same rule.
Where that fails too, a verbatim quote counts: a run of ``VERBATIM`` equal words, or of half the item if that is shorter
and ``MIN_EQUAL`` words at least.

Every pair is found by a seed: six words in a row or a spaced window must be left whole.  So an item of ten words or
fewer with a word inserted in its middle isn't found.  An item of fewer than six words is found where all its words
stand in a row, so an item of one word is held by every document with that word.

Equal items are one item until the end.  Documents' windows first pass a Bloom filter of the benchmark's hashes, of
bounded size, in the tasks that read them; only those that pass are joined, with a copy of each distinct text that has
one.  Neither benchmark nor documents pass the driver, and the join's sides may both grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FILTER_BITS, cut, filter_of, hash_words, maybe_known, save, ship

#: Two substitutions in twelve words, or three in sixteen, leave one of these windows whole; each hashes six words.
MASKS = ("111111", "1101011001", "1110010101", "1011001110", "1100110101")
MIN_EQUAL, MIN_SHARE, LONG_EQUAL, PENALTY = 8, 0.6, 25, -1
VERBATIM, BAND = 13, 16
#: Text bytes whose windows a task holds at once; one text stays whole.
TEXT_BYTES = 2 << 20

#: A score and a number of equal words in one integer, ordered by score first.
_ONE = 1 << 31
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the offsets of each text's words."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), r"[^\pL\pN]+", " ")
    lists = pc.ascii_split_whitespace(plain)
    offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.zeros(len(full) + 1, np.int64)
    np.cumsum(full, out=before[1:])
    return hash_words(flat.filter(pa.array(full))), before[offsets - offsets[0]]


def _windows(hashed: np.ndarray, mask: str) -> np.ndarray:
    """A hash for every window of the mask over all words of a batch; none where the batch is shorter."""
    n = max(len(hashed) - len(mask) + 1, 0)
    out = np.full(n, np.uint64(int(mask, 2)), np.uint64)
    for k in (k for k, c in enumerate(mask) if c == "1"):
        out = (out ^ hashed[k:k + n]) * _MIX
        out ^= out >> np.uint64(30)
    return out


def windows(hashed: np.ndarray, offsets: np.ndarray, masks: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(mask, text, first word, hash) of every window that lies within one text."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for mask in masks:
        h = _windows(hashed, mask)
        at = np.arange(len(h))
        at = at[owner[at] == owner[at + len(mask) - 1]]
        yield mask, owner[at], at - offsets[owner[at]], h[at]


def _whole(n: int) -> str:
    """The one mask of an item of ``n`` words that is shorter than all others."""
    return "1" * n


class Pair:
    """The words of an item against a stretch of a document, which begins at word ``base``; ``starts`` are the places of
    the item's first word at which a seed set the two against each other.  Stretches are (equal words, first word in the
    document, words)."""

    def __init__(self, item: np.ndarray, near: np.ndarray, base: int = 0):
        self.item, self.near, self.base = item, near, base

    def _same(self, start: int) -> tuple[int, np.ndarray]:
        """Where the two overlap, from which place of the stretch, and whether their words are equal there."""
        start -= self.base
        lo, hi = max(start, 0), min(start + len(self.item), len(self.near))
        return lo, self.near[lo:hi] == self.item[lo - start:hi - start]

    def enough(self, equal: int) -> bool:
        whole = len(self.item)
        return bool(equal >= min(MIN_EQUAL, whole) and equal >= MIN_SHARE * whole or equal >= LONG_EQUAL)

    def verify(self, start: int) -> tuple[int, int, int] | None:
        """The best stretch at one offset, where it counts."""
        lo, same = self._same(start)
        score = np.concatenate([[0], np.cumsum(np.where(same, 1, PENALTY))])
        lowest = np.minimum.accumulate(score)
        stop = int(np.argmax(score - lowest))
        begin = int(np.argmin(score[:stop + 1]))
        equal = int(same[begin:stop].sum())
        return (equal, self.base + lo + begin, stop - begin) if self.enough(equal) else None

    def align(self, least: int, most: int) -> tuple[int, int, int] | None:
        """As ``verify``, for the best local alignment of the item over all offsets from ``least`` to ``most`` and a band."""
        own, least, most = self.item, least - self.base, most - self.base
        if not self.enough(int(np.isin(own, self.near).sum())):
            return None
        starts = np.arange(least - BAND, most + BAND + 1)
        lo, hi, hashed = 0, len(self.near), self.near
        never, steps = -(1 << 60), np.arange(len(starts)) * _ONE
        index = np.arange(len(starts))
        value, begin = np.full(len(starts), never), starts.copy()
        before, before_begin = value, begin  # ended two words of the item earlier
        drop, drop_begin = value, begin  # words of the item left out since
        best, at = 0, (0, 0)
        for i, word in enumerate(own):
            place = starts + i
            inside = (place >= lo) & (place < hi)
            same = inside & (hashed[np.clip(place, lo, hi - 1)] == word)
            shifted = value + steps  # from this offset, or a lower one: words inserted
            top = np.maximum.accumulate(shifted)
            source = np.maximum.accumulate(np.where(shifted == top, index, 0))
            further, further_begin = top - steps, begin[source]
            dropped, dropped_begin = np.full(len(starts), never), starts.copy()
            later = drop[1:] > before[1:]
            dropped[:-1] = np.maximum(np.where(later, drop[1:], before[1:]) + PENALTY * _ONE, never)
            dropped_begin[:-1] = np.where(later, drop_begin[1:], before_begin[1:])
            drop, drop_begin = dropped, dropped_begin
            before, before_begin = value, begin
            begin = np.where(drop > further, drop_begin, further_begin)
            value = np.maximum(drop, further)
            begin = np.where(value > 0, begin, place)
            value = np.where(inside, np.maximum(value, 0) + np.where(same, _ONE + 1, PENALTY * _ONE), never)
            k = int(np.argmax(value))
            if value[k] > best:
                best, at = int(value[k]), (int(begin[k]), int(place[k]) + 1)
        equal = best & (_ONE - 1)
        return (equal, self.base + at[0], at[1] - at[0]) if best and self.enough(equal) else None

    def quoted(self, start: int) -> tuple[int, int, int] | None:
        """As ``verify``, for the longest run of equal words."""
        lo, same = self._same(start)
        ends = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
        run = np.diff(ends) - 1
        k = int(np.argmax(run))
        if run[k] < min(VERBATIM, max(MIN_EQUAL, len(self.item) // 2)):
            return None
        return int(run[k]), int(self.base + lo + ends[k] + 1), int(run[k])

    def best(self, starts: list[int]) -> tuple[int, int, int, int] | None:
        """(rank of the rule, equal words, first word, words) for offsets that lie near each other."""
        most = lambda found: max(filter(None, found), key=lambda x: (x[0], -x[1]), default=None)
        rules = (lambda: most(self.verify(x) for x in starts), lambda: self.align(starts[0], starts[-1]), lambda: most(self.quoted(x) for x in starts))
        return next(((rank, *got) for rank, rule in enumerate(rules) if (got := rule())), None)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, rep, words): equal sequences of words have one ``rep``."""
    for batch in cut(batches, "text"):
        hashed, offsets = words(batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashed.view(np.int64)))
        rep = [xxhash.xxh3_128_hexdigest(hashed[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        some = pa.array(np.diff(offsets) > 0)
        yield pa.record_batch([batch.column("item"), pa.array(rep, pa.string()), lists], ["item", "rep", "words"]).filter(some)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, rep, at, n): the windows of distinct items, ``n`` words long."""
    for batch in batches:
        lists = batch.column("words")
        hashed, offsets = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        size = np.diff(offsets)
        masks = [*MASKS, *(_whole(n) for n in np.unique(size) if n < len(MASKS[0]))]
        for mask, item, at, h in windows(hashed, offsets, masks):
            own = size[item] == len(mask) if mask not in MASKS else np.ones(len(item), bool)
            yield pa.record_batch([pa.array(h[own].view(np.int64)), batch.column("rep").take(pa.array(item[own])), pa.array(at[own]), pa.array(size[item[own]])],
                                  ["h", "rep", "at", "n"])


def _suspects(known: Broadcast, masks: list[str]):
    """(id, key, words, places, hashes) of the texts that have a window whose hash may be an item's."""
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text", TEXT_BYTES):
            hashed, offsets = words(batch.column("text"))
            found = []
            for mask, text, at, h in windows(hashed, offsets, masks):
                maybe = known.value.maybe(h)
                text, at, h = text[maybe], at[maybe], h[maybe]
                if mask not in MASKS:  # the first of each tells all
                    _, first = np.unique(np.stack([text, h.view(np.int64)]), axis=1, return_index=True)
                    text, at, h = text[first], at[first], h[first]
                found.append((text, at, h))
            text, at, h = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(text, kind="stable")
            n = np.bincount(text, minlength=batch.num_rows)
            some = pa.array(np.flatnonzero(n))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashed.view(np.int64)))
            of = pa.array(np.concatenate([[0], np.cumsum(n[n > 0])]), pa.int32())
            yield pa.record_batch([batch.column("id").take(some), batch.column("key").take(some), lists.take(some),
                                   pa.ListArray.from_arrays(of, pa.array(at[order])), pa.ListArray.from_arrays(of, pa.array(h[order].view(np.int64)))],
                                  ["id", "key", "words", "places", "hashes"])
    return suspects


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = [batch.column(c) for c in ("starts", "base", "near", "item_words")]
        for k, (starts, base, near, item) in enumerate(zip(*columns, strict=True)):
            pair = Pair(item.values.to_numpy(), near.values.to_numpy(), base.as_py())
            if got := pair.best(starts.as_py()):
                rows.append((k, *got))
        picked = np.array(rows, np.int64).reshape(-1, 5)
        at = pa.array(picked[:, 0])
        yield pa.record_batch([batch.column("key").take(at), batch.column("rep").take(at), *(pa.array(picked[:, k]) for k in range(1, 5))],
                              ["key", "rep", "rank", "equal_words", "first_word", "n_words"])


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str | None, text_col: str, item_col: str, item_text_col: str,
           filter_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(item, rep), (id, key) of the suspects, and the best stretch of each (key, rep) that counts; ``key`` tells a text."""
    ship(docs.sparkSession)
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    item_type = bench.schema["item"].dataType.simpleString()
    items = save(bench.mapInArrow(_items, f"item {item_type}, rep string, words array<long>"), "items")
    reps = items.groupBy("rep").agg(F.first("words").alias("words"))
    table = save(reps.mapInArrow(_item_windows, "h long, rep string, at long, n long"), "item-windows")
    short = [r.n for r in table.where(F.col("n") < len(MASKS[0])).select("n").distinct().collect()]

    base = docs.select((F.col(id_col) if id_col else F.lit(None).cast("int")).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.md5(F.col(text_col).cast("string")).alias("key")).where("text IS NOT NULL")
    id_type = base.schema["id"].dataType.simpleString()
    found = base.mapInArrow(_suspects(filter_of(table, "h", filter_bits), [*MASKS, *map(_whole, sorted(short))]),
                            f"id {id_type}, key string, words array<long>, places array<long>, hashes array<long>")
    found = save(found, "suspects")
    texts = found.groupBy("key").agg(F.first("words").alias("words"), F.first(F.arrays_zip("places", "hashes")).alias("windows"))
    hits = texts.select("key", F.explode("windows").alias("w")).select("key", F.col("w.places").alias("place"), F.col("w.hashes").alias("h"))
    hits = hits.join(table, "h").select("key", "rep", "n", (F.col("place") - F.col("at")).alias("start")).distinct()
    # offsets of one text and item at most BAND apart are looked at together
    side = Window.partitionBy("key", "rep").orderBy("start")
    new = F.coalesce(F.col("start") - F.lag("start").over(side) > BAND, F.lit(True)).cast("int")
    near = hits.withColumn("new", new).withColumn("near", F.sum("new").over(side.rowsBetween(Window.unboundedPreceding, 0)))
    near = near.groupBy("key", "rep", "near").agg(F.array_sort(F.collect_list("start")).alias("starts"), F.first("n").alias("n"))
    near = near.withColumn("base", F.greatest(F.element_at("starts", 1) - BAND, F.lit(0)))
    stretch = F.expr(f"slice(words, cast(base + 1 as int), cast(greatest(element_at(starts, -1) + {BAND} + n - base, 0) as int))")
    pairs = near.join(texts.select("key", "words"), "key").select("key", "rep", "starts", "base", stretch.alias("near"))
    pairs = pairs.join(reps.select("rep", F.col("words").alias("item_words")), "rep")
    checked = pairs.mapInArrow(_verify, "key string, rep string, rank long, equal_words long, first_word long, n_words long")
    best = checked.groupBy("key", "rep").agg(F.min(F.struct(
        "rank", (-F.col("equal_words")).alias("less"), "first_word", "n_words")).alias("b"))
    best = save(best.select("key", "rep", (-F.col("b.less")).alias("equal_words"), "b.first_word", "b.n_words"), "leaks")
    return items.select("item", "rep", F.size("words").cast("long").alias("item_words")), found.select("id", "key"), best


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, item_id, item_words, equal_words, first_word, n_words), a row for each document row and item that it
    holds: its best stretch (by the first rule that holds, then most equal words, then the first).

    Texts or items that are null, empty or without words match nothing.  An item is matched whatever its id, null
    included, and repeated items each give their rows; so do repeated documents.  An empty table on either side gives
    an empty result; other columns are not read.
    """
    items, texts, best = _leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, filter_bits)
    out = best.join(texts, "key").join(items, "rep").select("id", "item", "item_words", "equal_words", "first_word", "n_words")
    return out.withColumnsRenamed({"id": id_col, "item": "item_id"})


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns, nulls and repeated rows as they are.

    Rows pass straight through but for those whose text's hash may be a leaking text's, by a filter of bounded size."""
    _, _, best = _leaks(docs, benchmark, None, text_col, item_col, item_text_col, filter_bits)
    keys = best.select("key").distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    maybe = maybe_known(filter_of(keys.select(F.xxhash64("key").alias("h")), "h", filter_bits), F.xxhash64(F.md5(text)))
    marked = docs.select(F.struct("*").alias("row"), F.md5(F.col(text_col).cast("string")).alias("key"), maybe.alias("maybe"))
    stays = marked.where("maybe").join(keys, "key", "left_anti")
    return marked.where("not maybe").select("row.*").unionAll(stays.select("row.*"))
