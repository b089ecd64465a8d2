"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Text bytes that a task's Python code holds at once; longer batches are cut, one text stays whole.
BATCH_BYTES = 8 << 20

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        stage = tempfile.mkdtemp(prefix="riverbend-py-")  # the driver serves the archive from here
        sc.addPyFile(shutil.make_archive(os.path.join(stage, "riverbend"), "zip", os.path.dirname(package), "riverbend"))
    _SHIPPED.add(sc.applicationId)


def quoted(name: str) -> str:
    """A column's name as one, whatever stands in it."""
    return "`" + name.replace("`", "``") + "`"


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint root and read it back.

    Cuts the lineage: a lost executor costs the tasks that ran on it, not the steps before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds at most ``most`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, after lower-casing A-Z unless ``lower`` is false, flat, and the
    offsets of each text's words.  A null text has none."""
    plain = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(plain) if lower else plain)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.zeros(len(full) + 1, np.int64)
    np.cumsum(full, out=before[1:])
    return flat.filter(pa.array(full)), before[offsets - offsets[0]]


def hash_words(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word; each distinct word of the batch is hashed once."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    coded = flat.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return hashes[coded.indices.to_numpy(zero_copy_only=False)]


def pack(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


#: A Bloom filter's most bits: 64 MB in every Python worker.
FILTER_BITS = 1 << 29

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], np.uint64)


def places(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th place below ``bits`` of every hash in a Bloom filter."""
    mixed = hashes * _ODD[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD[1]
    return ((mixed >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


class HashFilter:
    """A Bloom filter for about ``keys`` 64-bit hashes in ``shards`` slices of ``width`` bits, each filled by one task; a
    hash uses ``k`` places of its own shard's slice.  It has ``per_key`` bits a key, but never more than ``most_bits``:
    where that is too few it errs more often, and only by saying of an unknown hash that it may be known."""

    def __init__(self, keys: int, most_bits: int = FILTER_BITS, shard_keys: int = 1 << 18, per_key: int = 48, most_k: int = 8):
        self.shards = -(-keys // shard_keys) or 1
        self.width = max(min(per_key * keys, most_bits) // self.shards // 8, 8) * 8
        self.k = min(max(round(0.7 * self.width * self.shards / max(keys, 1)), 1), most_k)
        self.bits = np.zeros(0, np.uint8)

    def shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(33)) % np.uint64(self.shards)).astype(np.int64)

    def slice_of(self, hashes: np.ndarray) -> bytes:
        """The slice of a shard that holds these hashes, all of that shard."""
        bits = np.zeros(self.width, bool)
        for k in range(self.k):
            bits[places(hashes, k, self.width)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be known."""
        out = np.zeros(len(hashes), bool)
        left = np.arange(len(hashes))
        for k in range(self.k):
            own = hashes[left]
            at = places(own, k, self.width) + self.shard(own) * self.width
            left = left[(self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
        out[left] = True
        return out

    def gather(self, slices: DataFrame) -> Broadcast:
        """The whole filter from (shard, bits) rows, on every executor; its size is bounded by ``most_bits``."""
        rows, size = slices.toArrow(), self.width // 8
        self.bits = np.zeros(self.shards * size, np.uint8)
        for shard, bits in zip(rows["shard"].to_pylist(), rows["bits"].to_pylist(), strict=True):
            self.bits[shard * size:(shard + 1) * size] = np.frombuffer(bits, np.uint8)
        return slices.sparkSession.sparkContext.broadcast(self)


def filter_of(hashes: DataFrame, column: str, most_bits: int = FILTER_BITS) -> Broadcast:
    """A broadcast :class:`HashFilter` of a column of 64-bit hashes."""
    own = HashFilter(hashes.count(), most_bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.unique(batch.column("h").to_numpy().view(np.uint64))
            yield pa.record_batch([pa.array(own.shard(known)), pa.array(known.view(np.int64))], ["shard", "h"])

    def fill(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(own.width // 8, np.uint8)
        for batch in batches:
            bits |= np.frombuffer(own.slice_of(batch.column("h").to_numpy().view(np.uint64)), np.uint8)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([bits.tobytes()], pa.binary())], ["shard", "bits"])

    dealt = hashes.select(F.col(column).alias("h")).mapInArrow(deal, "shard long, h long")
    return own.gather(dealt.groupBy("shard").applyInArrow(fill, "shard long, bits binary"))


def maybe_known(sent: Broadcast, hashes: Column) -> Column:
    """Whether a 64-bit hash may be in a broadcast filter."""
    @F.arrow_udf("boolean")
    def maybe(own: pa.Array) -> pa.Array:
        return pa.array(sent.value.maybe(own.to_numpy().view(np.uint64)))
    return maybe(hashes)
