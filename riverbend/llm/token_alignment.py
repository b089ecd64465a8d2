"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked tokens.

Every text is encoded by tokenizer A (a byte-level BPE, ``tokenizers``) and tokenizer B (``sentencepiece``) over the same
bytes, a blank and the text.  Neither has a token that crosses from a word to the blank after it, so a text is cut at
single blanks between ordinary characters and every distinct piece of a batch is encoded and aligned once.  Byte offsets at which
tokens of both end cut the text into groups; the A token and the B token that end there are linked.

How often each pair is linked in the whole corpus is counted externally.  A task turns the links of its texts into
(pair, document, times) records, radix-partitions them by the B id, and spills every ``RUN_RECORDS`` of them as one
sorted run a partition, compressed with zstd, into a table in the shared folder.  Runs are dealt to merges of about
``MERGE_RECORDS`` records, so a token that stands in every document is many merges.  A merge reads its runs a block at a
time through a heap, in the order of the B id, then the A id.  The first merge adds up each pair; what the merges of one
partition find is summed, and since a pair's B id comes first, the greatest count of a B id is that over one short
stretch, at most A's vocabulary.  The second merge goes along the totals in the same order and streams each record's
contribution back to its document.
"""

from __future__ import annotations

import heapq
import io
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, pack, save, ship
from .token_counts import _byte_symbols

#: Partitions of the B ids.
RADIX = 32
#: Links that a task holds before it spills, and records of one merge.
RUN_RECORDS, MERGE_RECORDS = 1 << 20, 1 << 21
#: Records of a block, the unit in which a run is read.
BLOCK = 4096
#: Text bytes that are encoded at once; one text stays whole.
STEP_BYTES = 2 << 20
#: Pieces that are encoded at once.
SLICE = 8192

_TABLES: dict[tuple[str, str], Tokens] = {}


class Vocabulary:
    """The bytes of every token, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = pa.array([str(k) for k in range(len(tokens))])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.bytes[np.arange(int(size.sum())) + np.repeat(self.start[ids] - (np.cumsum(size) - size), size)]


class Tokens:
    """Both tokenizers, loaded once by a Python worker."""

    def __init__(self, path_a: str, path_b: str):
        import os

        import sentencepiece
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        byte = {c: b for b, c in enumerate(_byte_symbols())}
        known = self.a.get_vocab()
        entries = [b""] * (max(known.values()) + 1)
        for entry, k in known.items():
            entries[k] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.of_a = Vocabulary(entries)
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        entries_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
                     for k in range(b.get_piece_size())]
        self.of_b = Vocabulary(entries_b)
        #: whether no token goes on from an ordinary character to a blank
        self.cut = not any(re.search(rb"[!-~] |(?:^|[\xC3-\xDF])[\x80-\xBF] ", t) for t in entries + entries_b)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, tokens of A in each text, and the same of B; none where the tokens' bytes aren't blank + text."""
        a, n_a = _flat([e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)])
        b, n_b = _flat(self.b.encode(texts, num_threads=1))
        plain = [b" " + t.encode() if t else b"" for t in texts]
        size, of = np.array([len(p) for p in plain], np.int64), np.arange(len(texts))
        of_a, of_b = np.repeat(of, n_a), np.repeat(of, n_b)
        good = size > 0
        for vocabulary, ids, owner in ((self.of_a, a, of_a), (self.of_b, b, of_b)):
            good &= np.bincount(owner, vocabulary.size[ids], len(texts)) == size
        own = np.frombuffer(b"".join(p for p, g in zip(plain, good.tolist(), strict=True) if g), np.uint8)
        of_byte, left = np.repeat(of[good], size[good]), good.copy()
        for vocabulary, ids, owner in ((self.of_a, a, of_a), (self.of_b, b, of_b)):
            left[of_byte[vocabulary.joined(ids[good[owner]]) != own]] = False
        return a[left[of_a]], np.where(left, n_a, 0), b[left[of_b]], np.where(left, n_b, 0)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and how many each has."""
    n = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


def _safe(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the bytes end, and begin, an ordinary character: printable ASCII but the blank, or a letter of two bytes from
    U+00C0 on that doesn't combine; white space of any kind is none."""
    plain = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF) & (data != 0xCC) & (data != 0xCD)
    ends = plain.copy()
    ends[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & lead[:-1]
    return ends, plain | lead


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of every text, flat, and the offsets of each text's pieces.  A text is cut at each blank between two
    ordinary characters, which is dropped; an empty text has no piece."""
    texts = pc.fill_null(texts.cast(pa.string()), "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    ends, begins = _safe(data)
    blank = np.zeros(len(data), bool)
    blank[1:-1] = (data[1:-1] == 0x20) & ends[:-2] & begins[2:]
    at = offsets[(offsets > 0) & (offsets < len(data))]
    blank[at] = False  # the neighbours are another text's
    blank[at - 1] = False
    gone = np.flatnonzero(blank)
    starts = np.sort(np.concatenate([offsets[:-1][np.diff(offsets) > 0], gone + 1]))
    before = np.concatenate([[0], np.cumsum(blank)])
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)) - before[np.append(starts, len(data))]),
                                            pa.py_buffer(data[~blank]))
    return flat, np.searchsorted(starts, offsets)


def tokens(path_a: str, path_b: str) -> Tokens:
    if (path_a, path_b) not in _TABLES:
        _TABLES[path_a, path_b] = Tokens(path_a, path_b)
    return _TABLES[path_a, path_b]


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _lists(names: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids of each group, joined by commas."""
    each = names.take(pa.array(ids))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(_offsets(np.diff(ends, prepend=-1)), pa.int32()), each), ",")


class Aligned(NamedTuple):
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: pa.Array
    #: text, A id and B id of every link
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray


def align_texts(own: Tokens, texts: list[str]) -> Aligned:
    a, n_a, b, n_b = own.encode(texts)
    end_a, end_b = np.cumsum(own.of_a.size[a]), np.cumsum(own.of_b.size[b])
    last_a, last_b = np.flatnonzero(np.isin(end_a, end_b, assume_unique=True)), np.flatnonzero(np.isin(end_b, end_a, assume_unique=True))
    owner = np.repeat(np.arange(len(texts)), n_a)[last_a]
    n_groups = np.bincount(owner, minlength=len(texts))
    groups = pc.binary_join_element_wise(_lists(own.of_a.names, a, last_a), _lists(own.of_b.names, b, last_b), "|")
    each = pa.ListArray.from_arrays(pa.array(_offsets(n_groups), pa.int32()), groups)
    return Aligned(n_a, n_b, n_groups, pc.binary_join(each, ";"), owner, a[last_a], b[last_b])


def _in_slices(own: Tokens, texts: pa.Array) -> Aligned:
    """As ``align_texts``, a few at a time: the libraries' own results take many times the room of the ids."""
    parts = [align_texts(own, texts.slice(k, SLICE).to_pylist()) for k in range(0, max(len(texts), 1), SLICE)]
    groups = pa.concat_arrays([p.groups for p in parts])
    text = np.concatenate([p.text + k * SLICE for k, p in enumerate(parts)])
    n_a, n_b, n_groups, a, b = (np.concatenate([getattr(p, c) for p in parts]) for c in ("n_a", "n_b", "n_groups", "a", "b"))
    return Aligned(n_a, n_b, n_groups, groups, text, a, b)


def align_batch(own: Tokens, texts: pa.Array) -> Aligned:
    """As ``align_texts``, by distinct pieces; a text with a piece that has no tokens is encoded as a whole."""
    if not own.cut:
        return align_texts(own, pc.fill_null(texts.cast(pa.string()), "").to_pylist())
    flat, offsets = pieces(texts)
    coded = flat.dictionary_encode()
    known, code = _in_slices(own, coded.dictionary), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    odd = np.unique(text[known.n_a[code] == 0])
    if len(odd):
        code, text = (x[~np.isin(text, odd)] for x in (code, text))
    n_a, n_b, n_groups = (np.bincount(text, n[code], len(texts)).astype(np.int64) for n in (known.n_a, known.n_b, known.n_groups))
    each = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), known.groups.take(pa.array(code)))
    groups, n = pc.binary_join(each, ";"), known.n_groups
    pick = np.arange(int(n[code].sum())) + np.repeat((np.cumsum(n) - n)[code] - (np.cumsum(n[code]) - n[code]), n[code])
    a, b, text = known.a[pick], known.b[pick], np.repeat(text, n[code])
    if len(odd):
        whole = align_texts(own, texts.take(pa.array(odd)).to_pylist())
        n_a[odd], n_b[odd], n_groups[odd] = whole.n_a, whole.n_b, whole.n_groups
        is_odd = np.zeros(len(texts), bool)
        is_odd[odd] = True
        groups = pc.replace_with_mask(groups, pa.array(is_odd), whole.groups)
        a, b, text = np.concatenate([a, whole.a]), np.concatenate([b, whole.b]), np.concatenate([text, odd[whole.text]])
    return Aligned(n_a, n_b, n_groups, groups, text, a, b)


def write_run(keys: np.ndarray, rows: np.ndarray, times: np.ndarray) -> bytes:
    """A sorted run: the documents' rows, then blocks of (key, place of the row, times)."""
    known, place = np.unique(rows, return_inverse=True)
    parts = [np.array([len(known)], np.int64).tobytes(), known.astype(np.int64).tobytes()]
    for k in range(0, len(keys), BLOCK):
        block = keys[k:k + BLOCK].astype(np.int64)
        parts += [np.array([len(block)], np.int64).tobytes(), np.diff(block, prepend=0).tobytes(),
                  place[k:k + BLOCK].astype(np.uint32).tobytes(), times[k:k + BLOCK].astype(np.uint32).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def read_run(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The blocks of a run, decompressed one after another."""
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(run)) as stream:
        def array(n: int, dtype: type) -> np.ndarray:
            want, got = n * np.dtype(dtype).itemsize, []
            while want and (piece := stream.read(want)):
                got.append(piece)
                want -= len(piece)
            return np.frombuffer(b"".join(got), dtype)

        known = array(int(array(1, np.int64)[0]), np.int64)
        while len(n := array(1, np.int64)):
            keys = np.cumsum(array(int(n[0]), np.int64))
            yield keys, known[array(int(n[0]), np.uint32)], array(int(n[0]), np.uint32).astype(np.int64)


def merge(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The records of all runs in the order of their keys, in stretches; a key is never in two stretches.

    Each run has one block in memory.  A heap of the blocks' first keys tells which of them reach below the least last
    key of all; up to there all records are known."""
    readers, held, turn = [read_run(r) for r in runs], {}, [0] * len(runs)
    heads, ends = [], []

    def load(k: int) -> None:
        block = next(readers[k], None)
        turn[k] += 1
        if block is not None:
            held[k] = block
            heapq.heappush(heads, (int(block[0][0]), k))
            heapq.heappush(ends, (int(block[0][-1]), k, turn[k]))

    for k in range(len(runs)):
        load(k)
    while heads:
        while turn[ends[0][1]] != ends[0][2]:
            heapq.heappop(ends)  # its block is read
        limit, taken = ends[0][0], []
        while heads and heads[0][0] <= limit:
            _, k = heapq.heappop(heads)
            block = held.pop(k)
            n = int(np.searchsorted(block[0], limit, side="right"))
            taken.append(tuple(x[:n] for x in block))
            if n == len(block[0]):
                load(k)
            else:
                held[k] = tuple(x[n:] for x in block)
                heapq.heappush(heads, (int(held[k][0][0]), k))
        keys, rows, times = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(keys, kind="stable")
        yield keys[order], rows[order], times[order]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once, with the sums of its values; ``keys`` are sorted."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], *(np.add.reduceat(v, first, dtype=np.int64) if len(first) else v[:0] for v in values)


_SPILL = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "bucket", "n_records", "run"]


def _spill(path_a: str, path_b: str, run_records: int, id_type: pa.DataType):
    """Rows of two kinds: a document with its groups, or a run of a bucket."""
    types = [pa.int64(), id_type, *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int64(), pa.binary()]

    def batch(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.record_batch([columns.get(name, pa.nulls(n, t)) for name, t in zip(_SPILL, types, strict=True)], _SPILL)

    def runs(links: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, rows = (np.concatenate(x) for x in zip(*links, strict=True))
        order = np.lexsort((rows, keys))
        keys, rows = keys[order], rows[order]
        new = np.flatnonzero((np.diff(keys, prepend=-1) != 0) | (np.diff(rows, prepend=-1) != 0))
        times, keys, rows = np.diff(new, append=len(keys)), keys[new], rows[new]
        bucket = (keys >> 32) % RADIX
        for k in np.unique(bucket):
            own = bucket == k
            yield batch(1, bucket=pa.array([k], pa.int32()), n_records=pa.array([int(own.sum())], pa.int64()),
                        run=pack([write_run(keys[own], rows[own], times[own])]))

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, links, n_links = tokens(path_a, path_b), [], 0
        for part in cut(batches, "text", STEP_BYTES):
            got = align_batch(own, part.column("text"))
            ids = part.column("id")
            yield batch(part.num_rows, row=part.column("row"), id=ids, n_a=pa.array(got.n_a), n_b=pa.array(got.n_b),
                        n_groups=pa.array(got.n_groups, pa.int64()), n_links=pa.array(got.n_groups, pa.int64()), groups=got.groups)
            links.append(((got.b << 32) | got.a, part.column("row").to_numpy()[got.text]))
            n_links += len(got.a)
            if n_links >= run_records:
                yield from runs(links)
                links, n_links = [], 0
        if n_links:
            yield from runs(links)
    return spill


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a merge's pairs."""
    for keys, _, times in merge([r for b in batches for r in b.column("run").to_pylist()]):
        keys, times = _summed(keys, times)
        yield pa.record_batch([pa.array(keys), pa.array(times)], ["key", "n"])


def _contribute(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """What a merge's records add to their documents; the totals come from other merges and are complete."""
    order = np.argsort(known := totals["key"].to_numpy())
    known, n, best = known[order], totals["n"].to_numpy()[order], totals["is_best"].to_numpy()[order]
    out, waiting, at = [np.zeros((3, 0), np.int64)], 0, 0

    def settled(parts: list[np.ndarray]) -> list[np.ndarray]:
        rows, *sums = np.concatenate(parts, axis=1)[:, np.argsort(np.concatenate([p[0] for p in parts]), kind="stable")]
        return [np.stack(_summed(rows, *sums))]

    for keys, rows, times in merge(runs["run"].to_pylist()):
        stop = at + int(np.searchsorted(known[at:], keys[-1], side="right"))
        place = at + np.searchsorted(known[at:stop], keys)
        out.append(np.stack([rows, times * best[place], times * n[place]]))
        at, waiting = stop, waiting + len(rows)
        if waiting >= RUN_RECORDS:
            out, waiting = settled(out), 0
    rows, n_best, count_sum = settled(out)[0]
    return pa.table([pa.array(rows), pa.array(n_best), pa.array(count_sum)], ["row", "n_best", "count_sum"])


class Alignment(NamedTuple):
    """``documents``: (row, id, n_a, n_b, n_groups, n_links, groups), ``row`` numbers the rows of the input;
    ``pairs``: (a_id, b_id, n, is_best); ``contributions``: (row, n_best, count_sum) of the rows that have links."""

    documents: DataFrame
    pairs: DataFrame
    contributions: DataFrame


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          run_records: int = RUN_RECORDS, merge_records: int = MERGE_RECORDS) -> Alignment:
    """Alignment of every text, counts of all linked pairs, and what the counts say of each text.

    ``groups`` lists the groups of a text as ``a1,a2|b1;a3|b2,b3``, the ids of A and of B in order.  ``is_best`` marks
    the pairs with the greatest count of their B id, ties included; ``n_best`` are a text's links of such pairs and
    ``count_sum`` is the sum of the counts over its links.  A null or empty text, and one of which the joined bytes of
    either side's tokens differ from a blank and the text, has no tokens: zeros and empty ``groups``.  Null and repeated
    ids are kept, repeated rows count each; an empty table gives empty ones; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType
    schema = (f"row long, id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups string, "
              "bucket int, n_records long, run binary")
    spilled = save(base.mapInArrow(_spill(path_a, path_b, run_records, to_arrow_type(id_type)), schema), "aligned", compression="zstd")
    documents = spilled.where("bucket IS NULL").select("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups")

    # merges of a bucket: by its records, of which each bucket tells the number
    sizes = {r.bucket: r.n for r in spilled.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n_records").alias("n")).collect()}
    merges = F.get(F.array(*(F.lit(-(-sizes.get(k, 0) // merge_records) or 1) for k in range(RADIX))), F.col("bucket"))
    runs = spilled.where("bucket IS NOT NULL").select("bucket", F.pmod(F.xxhash64("run"), merges).cast("int").alias("part"), "run")
    summed = runs.groupBy("bucket", "part").applyInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    b_id = F.shiftright("key", 32)
    totals = summed.withColumn("is_best", F.col("n") == F.max("n").over(Window.partitionBy(b_id)))
    totals = save(totals, "pairs")

    bucket = (b_id % RADIX).cast("int").alias("bucket")
    everywhere = totals.select("key", "n", "is_best", bucket).withColumn("part", F.explode(F.sequence(F.lit(0), (merges - 1).cast("int"))))
    added = runs.groupBy("bucket", "part").cogroup(everywhere.groupBy("bucket", "part")).applyInArrow(
        _contribute, "row long, n_best long, count_sum long")
    contributions = added.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    pairs = totals.select((F.col("key").bitwiseAND(0xFFFFFFFF)).cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "n", "is_best")
    return Alignment(documents, pairs, contributions)
