"""Keyed state on streams: latest row per key, latest improvements, and
reading / migrating / re-seeding that state.

The latest row per key is a built-in streaming aggregate (``max_by`` of the
row struct), so it runs in the JVM with a map-side partial step and the values
keep their types.  The state of a stopped query is read back as rows with the
``statestore`` data source; a new query is seeded by reading those rows,
rewritten, before its own input.  Processors that need their own logic run
with ``transformWithStateInPandas`` (RocksDB state store).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riverbend.operators.dedup import latest_improvements
from riverbend.session import remove, scratch_dir, ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def ensure_rocksdb(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB provider (fixed per query at start)
    and the processor classes importable on the workers."""
    ship_package(spark)
    if spark.conf.get(PROVIDER_CONF, "") != ROCKSDB:
        spark.conf.set(PROVIDER_CONF, ROCKSDB)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of a (stopped) latest-per-key query as rows: key column and value columns."""
    raw = spark.read.format("statestore").load(checkpoint)
    value = raw.schema["value"].dataType.names[0]  # the aggregate's picked row
    return raw.select("key.*", F.col(f"value.{value}.*"))


def run_available(query) -> None:
    """Block until an ``availableNow`` query has processed its input; re-raise failures."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def keyed_latest_stream(source: DataFrame, key: str, value_schema: T.StructType, arrival: str,
                        checkpoint: str, seed: str | None = None, trigger: dict | None = None, wait: bool = True):
    """Keep, per key, the value columns of the row with the largest ``arrival``.

    The query writes nothing (``noop`` sink); its checkpoint holds the state.
    Keys and values may be of any type; a row without ``arrival`` never wins.
    ``seed`` names a folder from :func:`migrate_state`: its rows are read
    before and beside the source, so a new checkpoint starts from them (give
    it again when the same checkpoint resumes).  The default trigger consumes
    the available input and stops (``wait`` blocks until then); pass e.g.
    ``{"processingTime": "10 seconds"}`` for a long-running job.
    """
    spark = source.sparkSession
    names = value_schema.names
    rows = source.select(key, *names)
    if seed is not None:
        rows = spark.readStream.schema(rows.schema).parquet(seed).unionByName(rows)
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*names), arrival).alias("latest"))
    q = (latest.writeStream.format("noop").option("checkpointLocation", checkpoint)
               .outputMode("update").trigger(**(trigger or {"availableNow": True})).start())
    if wait and trigger is None:
        run_available(q)
    return q


def migrate_state(spark: SparkSession, old_checkpoint: str, transform: Callable[[DataFrame], DataFrame]) -> str:
    """Read a query's keyed state, rewrite it (e.g. drop or add a nested field)
    and land it as the ``seed`` folder of the next version."""
    path = scratch_dir(spark, "state-seed")
    transform(read_state(spark, old_checkpoint)).write.parquet(path)
    return path


def latest_improvements_stream(df: DataFrame, key: str, ts: str, arrival: str, checkpoint: str, state_path: str,
                               write: Callable[[DataFrame, int], None],
                               trigger: Mapping | None = None) -> StreamingQuery:
    """Streaming form of :func:`riverbend.operators.dedup.latest_improvements`.

    Every micro-batch runs the batch operator, so a hot key is cut into bounded
    buckets; each key's newest time so far is a table under ``state_path`` per
    batch id and stands before the batch's rows.  ``arrival`` must be numeric
    and not fall from batch to batch.  A replayed batch reads the same table
    and writes the same rows (``write`` must be idempotent per batch id).
    """
    spark = df.sparkSession
    carry_schema = T.StructType([df.schema[key], df.schema[ts]])
    at = lambda batch_id: f"{state_path.rstrip('/')}/batch={batch_id}"

    def run(batch: DataFrame, batch_id: int) -> None:
        carried = batch.withColumn("__carry", F.lit(False)).withColumn("__first", F.lit(1))
        if batch_id > 0:
            before = spark.read.schema(carry_schema).parquet(at(batch_id - 1))
            other = [c for c in batch.columns if c not in (key, ts)]
            carried = carried.unionByName(before.select(
                key, ts, *[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in other],
                F.lit(True).alias("__carry"), F.lit(0).alias("__first")))
        better = latest_improvements(carried, key, ts, "__first", [arrival])
        write(better.filter(~F.col("__carry")).drop("__carry", "__first"), batch_id)
        carried.groupBy(key).agg(F.max(ts).alias(ts)).write.mode("overwrite").parquet(at(batch_id))
        if batch_id > 1:  # the batch before may be replayed, and reads the table before it
            remove(spark, at(batch_id - 2))

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


class KeepLatest(StatefulProcessor):
    """The value columns of the row with the largest ``arrival`` per key, in value state ``latest``; the state may
    begin with rows of a query before (``handleInitialState``)."""

    def __init__(self, names: list[str], arrival: str, schema: str):
        self.names, self.arrival, self.schema = names, arrival, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", self.schema)

    def _offer(self, pdf: pd.DataFrame) -> bool:
        best = pdf.sort_values(self.arrival, kind="stable").iloc[-1]
        now = self.latest.get()[self.names.index(self.arrival)] if self.latest.exists() else None
        if now is not None and now >= best[self.arrival]:
            return False
        self.latest.update(tuple(None if pd.isna(v := best[c]) else v.item() if hasattr(v, "item") else v for c in self.names))
        return True

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._offer(initialState)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if any([self._offer(pdf) for pdf in rows if len(pdf)]):
            yield pd.DataFrame([(key[0], *self.latest.get())], columns=["key", *self.names])

    def close(self) -> None:
        pass


def _newest_of(key: str, arrival: str):
    """One row per key and batch of rows: what a task reduces before the shuffle."""
    def newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.sort_values(arrival, kind="stable").drop_duplicates(key, keep="last")
    return newest


def keyed_latest_from(source: DataFrame, key: str, value_schema: T.StructType, arrival: str, checkpoint: str,
                      initial: DataFrame | None = None, trigger: dict | None = None):
    """Latest value columns per key with ``transformWithState``, from an initial state.

    ``initial`` (key and value columns, one row per key) is loaded into the state of
    a new checkpoint before the first batch and never read as input; keys that
    the stream doesn't bring keep it.  Value columns are of plain types;
    ``arrival`` is one of them and not NULL.  Rows are reduced to one per key in
    every task before they are shuffled, so a hot key comes as few rows.  Read the
    state with :func:`read_variable`.
    """
    spark = source.sparkSession
    ensure_rocksdb(spark)
    rows = source.select(F.col(key).alias("key"), *value_schema.names)
    reduced = rows.mapInPandas(_newest_of("key", arrival), rows.schema)
    first = None if initial is None else initial.select(F.col(key).alias("key"), *value_schema.names).groupBy("key")
    value = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in value_schema.fields)
    out = reduced.groupBy("key").transformWithStateInPandas(
        KeepLatest(value_schema.names, arrival, value), rows.schema, "Update", "None", initialState=first)
    q = (out.writeStream.format("noop").option("checkpointLocation", checkpoint).outputMode("update")
            .trigger(**(trigger or {"availableNow": True})).start())
    if trigger is None:
        run_available(q)
    return q


def read_variable(spark: SparkSession, checkpoint: str, name: str, key: str) -> DataFrame:
    """A value state variable of a (stopped) ``transformWithState`` query as rows: key and value columns."""
    raw = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    return raw.select(F.col("key.key").alias(key), "value.*")


def state_variables(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId) of a query's checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")


class KeepFirstTTL(StatefulProcessor):
    """First row per key; the "seen" mark expires ``ttl_ms`` of processing time
    after it was set, after which the key's next row is emitted again (a state
    TTL on keep-first deduplication).  Rows of one micro-batch are ordered by
    ``order`` before the first is taken."""

    def __init__(self, order: list[str], ttl_ms: int):
        self.order, self.ttl_ms = order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen BOOLEAN", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        # first row of each chunk, then the first of those: a key's rows are
        # never gathered into one frame
        firsts = [pdf.sort_values(self.order, kind="stable").head(1) for pdf in rows if len(pdf)]
        if firsts:
            self.seen.update((True,))
            yield pd.concat(firsts, ignore_index=True).sort_values(self.order, kind="stable").head(1)

    def close(self) -> None:
        pass


def keep_first_ttl_stream(df: DataFrame, key: str, order: list[str], ttl_ms: int) -> DataFrame:
    """Streaming keep-first per key with a processing-time state TTL (append mode).

    Output has the input's columns.  Uses ``ProcessingTime`` time mode; run it
    with a processing-time trigger (under ``availableNow`` this time mode keeps
    scheduling empty batches and does not finish) and stop it explicitly.
    """
    ensure_rocksdb(df.sparkSession)
    return df.groupBy(key).transformWithStateInPandas(
        KeepFirstTTL(order, ttl_ms), df.schema, "Append", "ProcessingTime")
