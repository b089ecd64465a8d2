"""Detection of periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
``max(MIN_WORDS, 2 * q)`` words that no neighbouring word extends.  So every word of a run stands in it twice or more.
A word that occurs once within its current segment, at first the whole text, can't join a run: it splits the segment,
and so on within the parts until nothing splits.  Parts of fewer than ``MIN_WORDS`` words are dropped.  Of ordinary
prose next to nothing is left.

The surviving segments are scanned by lag.  Lags below ``NEAR`` are compared word by word.  A run of period q from 2B
to 4B repeats a stretch of 2B words or more, which holds a whole block of B words that starts at a multiple of B; so a
scan of these lags compares hashes of such blocks only, and each doubling of the lag costs as much as one before.
Where blocks match, words are compared up to the ends of the stretch, and the whole run once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship, split_words

MIN_WORDS = 12
#: Lags below it are scanned word by word; twice the first block size.
NEAR = 8
#: Comparisons made at once.
STEP = 1 << 22

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _occurrences(keys: np.ndarray) -> np.ndarray:
    """How often each element's value occurs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=ordered[0] - 1 if len(keys) else 0))
    n = np.diff(edges, append=len(keys))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(n, n)
    return out


def segments(ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that no split takes, and the number of the segment in which each stands.

    ``ids`` numbers the words of a batch, ``owner`` their texts."""
    ids = ids.astype(np.int64)
    width = int(ids.max()) + 1 if len(ids) else 1
    at, segment = np.arange(len(ids)), owner.astype(np.int64)
    done_at, done_segment, numbered = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while len(at):
        stays = _occurrences(segment * width + ids[at]) > 1
        # a segment that keeps all its words is stable
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        size = np.diff(first, append=len(at))
        stable = np.repeat(np.add.reduceat(stays, first, dtype=np.int64) == size, size) & np.repeat(size >= MIN_WORDS, size)
        if stable.any():
            number = np.cumsum(np.diff(segment[stable], prepend=-1) != 0) + numbered
            numbered = int(number[-1])
            done_at.append(at[stable])
            done_segment.append(number)
        stays &= ~stable
        at, segment = at[stays], segment[stays]
        if len(at):
            new = (np.diff(at, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0)
            size = np.diff(np.flatnonzero(new), append=len(at))
            long = np.repeat(size >= MIN_WORDS, size)
            segment = np.cumsum(new)[long]
            at = at[long]
    at, segment = np.concatenate(done_at), np.concatenate(done_segment)
    order = np.argsort(segment, kind="stable")
    return at[order], segment[order]


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... size[0] of them, then those of the next."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


def _near(x: np.ndarray, lag: int) -> np.ndarray:
    """(start, stop, lag) of the stretches whose words equal those ``lag`` words on, and that are long enough."""
    same = np.concatenate([[False], x[:-lag] == x[lag:], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    start, stop = edges[::2], edges[1::2] + lag
    ok = stop - start >= max(MIN_WORDS, 2 * lag)
    return np.stack([start[ok], stop[ok], np.full(int(ok.sum()), lag)], axis=1)


def _primitive(found: list[np.ndarray]) -> np.ndarray:
    """All stretches found, by start and stop, each once with the smallest of its periods."""
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[(np.diff(runs[:, 0], prepend=-1) != 0) | (np.diff(runs[:, 1], prepend=-1) != 0)]


def _last_run(runs: np.ndarray, n: int) -> np.ndarray:
    """For every place (stop, period) of the run that ends last of those that cover it, else a stop of 0."""
    by_stop = runs[np.argsort(runs[:, 1], kind="stable")]
    size = by_stop[:, 1] - by_stop[:, 0]
    out = np.tile(np.array([0, 1]), (n, 1))
    out[_flat(by_stop[:, 0], size)] = np.repeat(by_stop[:, 1:], size, axis=0)
    return out


def _matches(hashed: np.ndarray, block: int, most_lag: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) of the aligned blocks that come back 2 to 4 blocks further on."""
    n = len(hashed)
    wide = min(2 * block, most_lag - 2 * block + 1)
    rows = max(STEP // wide, 1)
    starts = np.arange(0, n - 2 * block, block)
    for part in (starts[k:k + rows] for k in range(0, len(starts), rows)):
        lo, hi = int(part[0]) + 2 * block, int(part[-1]) + 2 * block + wide
        own = hashed[part]
        near = np.full(hi - lo, ~hashed[0], np.uint64)
        near[:max(min(hi, n) - lo, 0)] = hashed[lo:min(hi, n)]
        table = np.lib.stride_tricks.sliding_window_view(near, wide)[::block]
        row, lag = np.nonzero(table == own[:, None])
        lag = lag + 2 * block
        real = part[row] + lag < n
        yield part[row][real], lag[real]


def _stretch(x: np.ndarray, at: np.ndarray, last: np.ndarray, lag: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place + 1 of the words around the blocks from ``at`` to ``last`` that equal those ``lag`` on."""
    lo, hi = at.copy(), last + block
    step, n = np.arange(block), len(x)
    rows = max(STEP // block, 1)
    for k in range(0, len(at), rows):
        s = slice(k, k + rows)
        left = at[s, None] - 1 - step
        same = (left >= 0) & (x[np.maximum(left, 0)] == x[np.maximum(left + lag[s, None], 0)])
        lo[s] -= np.where(same.all(axis=1), block, np.argmin(same, axis=1))
        right = hi[s, None] + step
        there = right + lag[s, None]
        same = (there < n) & (x[np.minimum(right, n - 1)] == x[np.minimum(there, n - 1)])
        hi[s] += np.where(same.all(axis=1), block, np.argmin(same, axis=1))
    return lo, hi


def scan(x: np.ndarray, longest: int) -> np.ndarray:
    """(start, stop, period) of all runs of a sequence of words that differ between segments; ``longest`` segment."""
    n, found = len(x), [np.zeros((0, 3), np.int64)]
    for lag in range(1, min(NEAR, longest // 2 + 1)):
        found.append(_near(x, lag))
    block, hashed = 1, x.astype(np.uint64) * _ODD
    hashed ^= hashed >> np.uint64(32)
    while 4 * block <= longest:
        if 2 * block >= NEAR:
            found = [_primitive(found)]
            known, pairs = _last_run(found[0], n), []
            for at, lag in _matches(hashed, block, longest // 2):
                # block and lag in one run, of which the lag is a multiple of the period, are that run again
                new = (at + lag + block > known[at, 0]) | (lag % known[at, 1] != 0)
                pairs.append(np.stack([lag[new], at[new]]))
            lag, at = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
            order = np.lexsort((at, lag))
            at, lag = at[order], lag[order]
            # neighbouring blocks at one lag are one stretch
            first = np.flatnonzero((np.diff(at, prepend=-1) != block) | (np.diff(lag, prepend=0) != 0))
            end = np.append(first[1:], len(at))[:len(first)] - 1
            lag = lag[first]
            lo, hi = _stretch(x, at[first], at[end], lag, block)
            ok = hi - lo >= np.maximum(MIN_WORDS - lag, lag)
            found.append(np.stack([lo[ok], hi[ok] + lag[ok], lag[ok]], axis=1))
        mixed = (hashed[:n - 2 * block + 1] ^ (hashed[block:] + _MIX)) * _ODD
        mixed ^= mixed >> np.uint64(29)
        hashed = (mixed + hashed[block:]) * _MIX
        hashed ^= hashed >> np.uint64(32)
        hashed, block = hashed[:n - 2 * block + 1], 2 * block
    runs = _primitive(found)
    size = runs[:, 1] - runs[:, 0] - runs[:, 2]
    same = x[_flat(runs[:, 0], size)] == x[_flat(runs[:, 0] + runs[:, 2], size)]
    whole = np.add.reduceat(same, np.cumsum(size) - size, dtype=np.int64) == size if len(runs) else np.zeros(0, bool)
    return runs[whole]


def find_runs(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of every run, by text, start and period; ``offsets`` of each text's words."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at, segment = segments(ids, owner)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    _, size = np.unique(segment, return_counts=True)
    runs = scan(segment * (int(ids.max()) + 1) + ids[at], int(size.max()))
    text = owner[at[runs[:, 0]]]
    out = np.stack([text, at[runs[:, 0]] - offsets[text], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, "text"):
        flat, offsets = split_words(batch.column("text"), lower=False)
        coded = flat.dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False)
        runs = find_runs(ids, offsets)
        # words of a run after its first period go
        change = np.zeros(len(ids) + 1, np.int64)
        start = offsets[runs[:, 0]] + runs[:, 1]
        np.add.at(change, start + runs[:, 3], 1)
        np.add.at(change, start + runs[:, 2], -1)
        stays = np.cumsum(change[:-1]) == 0
        left = np.concatenate([[0], np.cumsum(stays)])[offsets]
        words = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat if stays.all() else flat.filter(pa.array(stays)))
        per_text = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1))
        each = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
        yield pa.record_batch([batch.column("id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), each),
                               pc.binary_join(words, " ")], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), a row for every row of ``docs``.

    ``runs`` are (start, length, period) by start, then period, in words ``[^\\x20\\x09-\\x0D]+`` numbered from 0.
    ``collapsed`` are the words that no run contains after its first period, joined by single blanks.  A null or empty
    text has no words, no runs and an empty ``collapsed``.  Null and repeated ids are kept; an empty table gives an empty
    one; other columns are not read.  A text is searched as a whole by one task, in memory of a few times its size.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return base.mapInArrow(_collapse, schema).withColumnRenamed("id", id_col)
