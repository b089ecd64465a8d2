"""Near-duplicate texts: banded MinHash candidates, sequential Bayesian pruning, exact check.

A text's set holds its distinct shingles of five words (``split_words``); a shorter text is one shingle.

1. One pass computes, per document, the set's size, a 128-bit digest of the set, ``BANDS * ROWS`` minimum
   hashes kept as one byte each, and one key per band.  Documents with equal digests are one class.
2. Classes that share a band key are candidates.  A bucket's pairs are never emitted: first every member is
   compared with the member that stands in the most and largest buckets, which is near to most copies.  Where a bucket
   then still holds several components, its members are dealt into chunks of about ``CHUNK`` members and ``CHUNK_BYTES`` and each pair of chunks
   compares, inside one task, all members that differ in component; only links come out.  So the components are the
   ones that all pairs of all buckets would give.
3. A pair's signature bytes are compared batch by batch.  After each batch the pair goes if the posterior
   probability (uniform prior) that its similarity reaches the threshold is below ``MISS``.
4. What survives is checked on the full sets (64-bit shingle hashes).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, hash_words, pack, quoted, save, ship, split_words
from .graph import components

SHINGLE = 5
#: Similarity, as a ratio of whole numbers.
THRESHOLD = (75, 100)
#: 32 bands of 5: a pair at 0.75 shares no band with probability 1.7e-4, at 0.8 with 3e-6.
BANDS, ROWS = 32, 5
#: Signature bytes compared at a time, and the probability at which a pair is given up.
BATCH, MISS = 32, 1e-6
#: Members of a bucket that one task compares with as many others, and the most bytes of their sets (a longer set is a
#: chunk by itself).
CHUNK, CHUNK_BYTES = 512, 64 << 20

#: Text bytes whose shingles a task holds at once; one text stays whole.
TEXT_BYTES = 4 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _hashers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = BANDS * ROWS
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, offsets = split_words(texts)
    words = hash_words(flat)
    n = max(len(words) - size + 1, 0)
    rolled = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        rolled = (rolled ^ words[k:k + n]) * _MIX
        rolled ^= rolled >> np.uint64(29)
    out = []
    for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
        if stop - start >= size:
            out.append(np.unique(rolled[start:stop - size + 1]))
        elif stop > start:
            out.append(np.array([xxhash.xxh64_intdigest(words[start:stop].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhash(values: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of a set under each hash function, in slices that stay in the cache."""
    mul, add = _hashers()
    out = np.full(len(mul), 2**64 - 1, np.uint64)
    for start in range(0, len(values), 512):
        hashed = values[start:start + 512, None] * mul
        hashed += add
        np.minimum(out, hashed.min(axis=0), out=out)
    return out >> np.uint64(32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, "text", TEXT_BYTES):
        sets = shingle_sets(batch.column("text"))
        n = np.array([len(s) for s in sets], np.int64)
        digests: list[bytes | None] = [None] * len(sets)
        bytes_, bands = [None] * len(sets), [None] * len(sets)
        for i, s in enumerate(sets):
            if len(s) and batch.column("id")[i].is_valid:
                digests[i] = xxhash.xxh3_128_digest(s.tobytes())
                least = minhash(s)
                bytes_[i] = (least & np.uint64(255)).astype(np.uint8).tobytes()
                rows = least.reshape(BANDS, ROWS)
                key = np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    key = (key ^ rows[:, r]) * _MIX
                    key ^= key >> np.uint64(31)
                bands[i] = key.view(np.int64)
        yield pa.record_batch([batch.column("id"), pa.array(n), pack(digests), pack(bytes_),
                               pa.array(bands, pa.list_(pa.int64()))], ["id", "n", "digest", "signature", "bands"])


@lru_cache(1)
def least_matches() -> list[tuple[int, int]]:
    """(bytes compared, fewest equal ones with which a pair is kept) after each batch."""
    s = (np.arange(4000) + 0.5) / 4000
    equal = s + (1 - s) / 256  # unequal minima share a byte by chance
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(equal) + (n - m) * np.log1p(-equal)
            weight = np.exp(log - log.max())
            if weight[s >= THRESHOLD[0] / THRESHOLD[1]].sum() / weight.sum() >= MISS:
                out.append((n, m))
                break
    return out


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = BANDS * ROWS
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, width) for c in ("signature_a", "signature_b"))
        alive, equal, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
        for n, least in least_matches():
            equal = equal + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
            kept = equal >= least
            alive, equal, done = alive[kept], equal[kept], n
        yield batch.select(["a", "b"]).take(pa.array(alive))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, "set_b"):
        kept = []
        for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
            if _linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)):
                kept.append(i)
        yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if len(y) > len(x):
        x, y = y, x
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return THRESHOLD[1] * both >= THRESHOLD[0] * (len(x) + len(y) - both)


def _settle(schema: pa.Schema):
    def settle(key: tuple, table: pa.Table) -> pa.Table:
        """Links between the members of two chunks of a bucket, or within one, that differ in component."""
        table = table.combine_chunks()
        side = table["side"].to_numpy()
        left = np.flatnonzero(side == 0)
        right = left if key[1] == key[2] else np.flatnonzero(side == 1)
        signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(len(table), -1)
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["set"].combine_chunks()]
        component = table["c"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        n = np.array([len(x) for x in sets], np.int64)
        (first, least), *more = least_matches()
        found: list[tuple[int, int]] = []
        for start in range(0, len(left), 64):
            own = left[start:start + 64]
            equal = (signature[own, None, :first] == signature[None, right, :first]).sum(axis=2)
            i, j = np.nonzero((component[own, None] != component[right]) & (equal >= least))
            equal, i, j = equal[i, j], own[i], right[j]
            kept = (np.minimum(n[i], n[j]) * THRESHOLD[1] >= np.maximum(n[i], n[j]) * THRESHOLD[0]) & ((i < j) | (key[1] != key[2]))
            equal, i, j, done = equal[kept], i[kept], j[kept], first
            for stop, fewest in more:
                equal = equal + (signature[i, done:stop] == signature[j, done:stop]).sum(axis=1)
                kept, done = equal >= fewest, stop
                equal, i, j = equal[kept], i[kept], j[kept]
            same = bands[i] == bands[j]
            here = bands[i, same.argmax(axis=1)] == key[0].as_py()  # a pair counts in its first bucket
            found += [(x, y) for x, y in zip(i[here], j[here], strict=True) if _linked(sets[x], sets[y])]
        rep = table["rep"].combine_chunks()
        at = np.array(found, np.int64).reshape(-1, 2)
        return pa.table([rep.take(pa.array(at[:, 0])), rep.take(pa.array(at[:, 1]))], schema=schema)
    return settle


def _collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, "text", TEXT_BYTES):
        yield pa.record_batch([batch.column("id"), pack([s.tobytes() for s in shingle_sets(batch.column("text"))])], ["id", "set"])


class _Verifier:
    """Links among pairs (a, b) of class representatives."""

    def __init__(self, classes: DataFrame, sets: DataFrame, id_type: str):
        self.classes, self.sets, self.schema = classes, sets, f"a {id_type}, b {id_type}"

    def _with(self, pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("rep").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
        return pairs

    def links(self, pairs: DataFrame) -> DataFrame:
        low, high = THRESHOLD
        near = self._with(pairs, self.classes, "n", "signature").where(
            F.least("n_a", "n_b") * high >= F.greatest("n_a", "n_b") * low)
        near = save(near.select("a", "b", "signature_a", "signature_b").mapInArrow(_prune, self.schema), "near")
        full = self._with(near, self.sets, "set").select("a", "b", "set_a", "set_b")
        return save(full.mapInArrow(_confirm, self.schema).distinct(), "confirmed")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id reachable over links (itself included) and ``kept`` marks the
    document that has it.  Texts that are null, empty or without words have no shingles and link with nothing;
    so do rows without an id (component null, kept).  Rows that repeat an id are one document of the graph.
    An empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    signed = save(base.mapInArrow(_sign, f"id {id_type}, n long, digest binary, signature binary, bands array<long>"), "signatures")
    classes = save(signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("n", "signature", "bands"))), "classes")

    banded = classes.select("rep", "n", F.explode("bands").alias("key"))
    shared = save(banded.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1"), "buckets")
    members = save(banded.drop("n").join(shared, "key"), "members")
    wanted = members.groupBy("rep").agg(F.sum("size").alias("seen"))
    heads = members.join(wanted, "rep").groupBy("key").agg(F.min(F.struct(-F.col("seen"), "rep")).getField("rep").alias("head"))
    # a row that repeats another's id and set adds nothing
    sets = save(base.join(wanted.select(F.col("rep").alias("id")), "id", "left_semi").mapInArrow(_collect_sets, f"id {id_type}, set binary")
                .where(F.length("set") > 0).select(F.col("id").alias("rep"), "set").distinct(), "sets")

    verifier = _Verifier(classes, sets, id_type)
    links = verifier.links(members.join(save(heads, "heads"), "key").where("rep != head").select(
        F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct())
    found = save(components(links), "components")
    placed = members.join(found, members.rep == found.node, "left").select("key", "size", "shingles", "rep", F.coalesce("component", "rep").alias("c"))
    split = save(placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("key"), "unsettled")
    dealt = placed.join(split, "key").withColumn("k", F.ceil(F.greatest(F.col("size") / CHUNK, F.col("shingles") * 8 / CHUNK_BYTES)).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    dealt = dealt.join(classes.select("rep", "signature", "bands"), "rep").join(sets, "rep").withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
    dealt = dealt.select("key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
                         F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "rep", "c", "signature", "bands", "set")
    kind = to_arrow_type(base.schema["id"].dataType)
    settle = _settle(pa.schema([("a", kind), ("b", kind)]))
    more = save(dealt.groupBy("key", "one", "two").applyInArrow(settle, verifier.schema).distinct(), "settled")
    found = components(links.union(more))

    placed = classes.join(found, classes.rep == found.node, "left").select("digest", F.coalesce("component", "rep").alias("component"))
    return signed.join(placed, "digest", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; all its columns.

    Of rows that repeat both id and text one stays; rows that repeat an id with other texts are one document and stay
    or go together.  Rows without an id, and texts without words, stay.
    """
    linked = link_documents(docs, id_col, text_col)
    gone = linked.where("NOT kept").select(F.col(id_col).alias("gone")).distinct()
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("repeated"))
    marks = save(gone.join(repeated, F.col("gone") == F.col("repeated"), "full"), "marks")
    row = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    once = row.join(marks, F.col("id") == F.coalesce("gone", "repeated"), "left").where("gone IS NULL")
    single = once.where("repeated IS NULL").select("row")
    several = once.where("repeated IS NOT NULL").groupBy("id", "hash").agg(F.first("row").alias("row")).select("row")
    return single.union(several).select(*(F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))
