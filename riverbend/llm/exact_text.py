"""Exact dedup by two Bloom filter passes.

Texts are equal when they are identical after lower-casing A-Z.  The first pass reads a 64-bit hash of every text.
Hashes are dealt to shards of about ``SHARD_KEYS``; a shard sets each hash in a Bloom filter of its own and notes a hash
that was already there in its slice of a second filter.  The second filter has ``FILTER_BITS`` bits at most, whatever the
table, and is all that leaves the first pass.

In the second pass every task looks its rows up in it.  A row whose hash isn't there has no equal and passes straight
through; only the others, the repeated ones and the filter's few errors, are shuffled, as id and SHA-256 digest.  Where a
table is so large that the filter fills up, more rows are shuffled and the result is the same.

A group of copies may hold a third of all rows, so it is reduced, and met again, in salted parts of about ``PART_ROWS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, HashFilter, maybe_known, places, save, ship

#: Hashes of one shard of the first filter, which has 16 bits for each.
SHARD_KEYS, FIRST_BITS = 1 << 18, 1 << 22
PART_ROWS = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column | str) -> Column:
    """The text with A-Z in lower case; a null text counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _deal(plan: HashFilter):
    """(shard, hash, many): the hashes of a batch, each once, and whether the batch has it more than once."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, n = np.unique(batch.column("h").to_numpy().view(np.uint64), return_counts=True)
            yield pa.record_batch([pa.array(plan.shard(hashes)), pa.array(hashes.view(np.int64)), pa.array(n > 1)], ["shard", "h", "many"])
    return deal


def _note(plan: HashFilter):
    """A shard's slice of the second filter."""
    def note(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(FIRST_BITS, bool), np.zeros(plan.width // 8, np.uint8)
        for batch in batches:
            hashes, index, n = np.unique(batch.column("h").to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
            at = [places(hashes, k, FIRST_BITS) for k in range(4)]
            repeated = (n > 1) | np.logical_and.reduce([seen[x] for x in at])
            repeated[index[batch.column("many").to_numpy(zero_copy_only=False)]] = True
            for x in at:
                seen[x] = True
            again |= np.frombuffer(plan.slice_of(hashes[repeated]), np.uint8)
        if again.any():
            yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([again.tobytes()], pa.binary())], ["shard", "bits"])
    return note


def _filtered(docs: DataFrame, text_col: str, filter_bits: int, shard_keys: int) -> tuple[Column, int]:
    """First pass: a condition that holds for every row of ``docs`` whose text is repeated, and the number of rows."""
    ship(docs.sparkSession)
    rows = docs.count()
    plan = HashFilter(rows, filter_bits, shard_keys, per_key=16, most_k=4)
    text_hash = F.xxhash64(normalised(F.col(text_col)))
    dealt = docs.select(text_hash.alias("h")).mapInArrow(_deal(plan), "shard long, h long, many boolean")
    sent = plan.gather(dealt.groupBy("shard").applyInArrow(_note(plan), "shard long, bits binary"))
    return maybe_known(sent, text_hash), rows


def label_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS,
                 shard_keys: int = SHARD_KEYS, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for every row of ``docs``.

    Of equal texts the row with the largest id stays; a null id is the least, and of rows that repeat the largest id one
    stays.  ``keep_id`` is its id, ``group_size`` the number of equal texts, itself included.  A null text counts as empty,
    and empty texts are equal.  An empty table gives an empty one; other columns are not read.
    """
    maybe, rows = _filtered(docs, text_col, filter_bits, shard_keys)
    slim = docs.select(F.col(id_col).alias("id"), maybe.alias("maybe"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"),
                       F.monotonically_increasing_id().alias("row"))
    slim = save(slim, "digests")
    part = F.pmod(F.xxhash64("row"), F.lit(1 + rows // part_rows))
    some = slim.where("maybe").select("id", "row", "sha", part.alias("part"))
    # parts of a group, then the group, then the group's totals in each of its parts
    parts = some.groupBy("sha", "part").agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("n"))
    groups = parts.groupBy("sha").agg(F.max("last").alias("keep"), F.sum("n").alias("size"))
    totals = parts.select("sha", "part").join(groups, "sha")
    copies = some.join(totals, ["sha", "part"]).select(
        "id", F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("keep.row")).alias("kept"), "sha")
    alone = slim.where("not maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return alone.unionByName(copies).withColumnsRenamed({"id": id_col, "sha": "text_sha256"})


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS,
                shard_keys: int = SHARD_KEYS) -> DataFrame:
    """The rows of ``docs`` that stay by the rule of :func:`label_copies`, one for each distinct text, with all their
    columns as they are.  Rows that aren't flagged are not shuffled; a group of copies is reduced in every task first."""
    maybe, _ = _filtered(docs, text_col, filter_bits, shard_keys)
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), maybe.alias("maybe"),
                         F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
    last = marked.where("maybe").groupBy("sha").agg(F.max_by("row", F.struct("id", F.lit(0))).alias("row"))
    return marked.where("not maybe").select("row.*").unionAll(last.select("row.*"))
