"""A partitioned Parquet table written by a stream and compacted as it is written.

Spark's file sink never touches a file again, so a day that gets a few rows in
each batch ends as many small files.  Here a table has data files and, per
batch, a manifest: the list of the files that make up the table after that
batch.  A batch that adds rows to a day takes the day's small files up, writes
their rows and its own as new files, and lists those instead.  A manifest
counts once its folder holds the committer's ``_SUCCESS``, which is
written last; so readers see a table before a batch or after it, never
between, and a batch that fails or is replayed changes nothing that is listed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.session import remove

#: Files below this size are taken up when their day gets more rows.
SMALL_BYTES = 64 << 20
#: A day's rows of one batch are written as one file for each so many.
FILE_ROWS = 1 << 22

MANIFEST = T.StructType([T.StructField("folder", T.StringType()), T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType())])


class ManifestTable:
    """A table below ``path`` with rows of ``schema``, in folders by ``partition_col`` (a string column).  ``split_by`` is
    the column whose hash deals a large day's rows to files; by default all columns are hashed."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_col: str, small_bytes: int = SMALL_BYTES,
                 split_by: str | None = None, file_rows: int = FILE_ROWS):
        self.file_rows = file_rows
        self.spark, self.path, self.schema, self.partition_col = spark, path.rstrip("/"), schema, partition_col
        self.small_bytes, self.split_by = small_bytes, split_by

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _manifest(self, batch_id: int) -> str:
        return f"{self.path}/manifest/batch={batch_id}"

    def _data(self, batch_id: int) -> str:
        return f"{self.path}/data/batch={batch_id}"

    def committed(self, batch_id: int) -> bool:
        return batch_id >= 0 and self._exists(f"{self._manifest(batch_id)}/_SUCCESS")

    def versions(self) -> list[int]:
        """Batches whose manifest counts, in order."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
        return sorted(b for n in names if n.startswith("batch=") and self.committed(b := int(n[6:])))

    def files(self, batch_id: int | None = None) -> DataFrame:
        """(folder, file, bytes) of the table's files after a batch, by default the last."""
        versions = self.versions()
        if batch_id is None:
            batch_id = versions[-1] if versions else -1
        if batch_id not in versions:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._manifest(batch_id))

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        # the folder's name becomes the column again
        own = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*files)
        return own.select(*self.schema.names)

    def read(self, batch_id: int | None = None) -> DataFrame:
        """The table's rows after a batch, by default the last.  The list of its files passes the driver, as for any
        scan; their rows don't."""
        return self._read([r.file for r in self.files(batch_id).select("file").toLocalIterator()])

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch's rows.  A batch that is committed already changes nothing; one that failed is written anew."""
        if self.committed(batch_id):
            return
        before = self.files(max((v for v in self.versions() if v < batch_id), default=-1))
        touched = batch.select(F.col(self.partition_col).cast("string").alias("folder")).distinct()
        taken = before.filter(F.col("bytes") < self.small_bytes).join(touched, "folder", "left_semi")
        # small files of the days that get rows: about one for each such day
        taken_files = [r.file for r in taken.select("file").collect()]
        rows = batch.select(*self.schema.names).unionByName(self._read(taken_files))
        # one task, and so one file, for each FILE_ROWS rows of a day
        day = F.col(self.partition_col)
        files = rows.groupBy(day.alias("__day")).agg(F.ceil(F.count(F.lit(1)) / self.file_rows).alias("__files"))
        dealt = rows.join(files, day.eqNullSafe(F.col("__day"))).withColumn(
            "__file", F.pmod(F.xxhash64(*([self.split_by] if self.split_by else self.schema.names)), F.col("__files")))
        (dealt.repartition(self.partition_col, "__file").select(*self.schema.names)
              .write.mode("overwrite").partitionBy(self.partition_col).parquet(self._data(batch_id)))
        # listed, not read: the content column is pruned
        written = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                       .load(self._data(batch_id)).select(
                           F.regexp_extract("path", f"/{self.partition_col}=([^/]*)/[^/]*$", 1).alias("folder"), F.col("path").alias("file"),
                           F.col("length").alias("bytes")))
        kept = before.join(taken.select("file"), "file", "left_anti").select(*MANIFEST.names)
        kept.unionByName(written).write.mode("overwrite").parquet(self._manifest(batch_id))

    def vacuum(self, keep: int = 2) -> int:
        """Delete the files that none of the last ``keep`` versions lists, and the manifests before them; returns how many
        files.  Nothing may still read an older version."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        if not old:
            return 0
        live = self.files(kept[0])
        for v in kept[1:]:
            live = live.unionByName(self.files(v))
        dead = self.files(old[0])
        for v in old[1:]:
            dead = dead.unionByName(self.files(v))
        gone = dead.select("file").distinct().join(live.select("file"), "file", "left_anti")
        n = 0
        for r in gone.toLocalIterator():
            remove(self.spark, r.file)
            n += 1
        for v in old:
            remove(self.spark, self._manifest(v))
        return n


def stream_to_manifest(df: DataFrame, table: ManifestTable, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Write a stream into a :class:`ManifestTable`, compacting as it goes."""
    w = df.writeStream.foreachBatch(table.append).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
