"""Session construction and the shared scratch folder.

Jobs that must cut lineage or land intermediate files write below the folder
the cluster names in ``spark.checkpoint.dir``.  Only a local session (tests,
benchmarks) may fall back to a private folder when that setting is absent.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session built here gets.  AQE re-plans joins and coalesces
# shuffle partitions from runtime statistics; the skew-join rule splits a
# partition that one hot key made large.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a table of thousands of folders is listed by this many tasks, not by one each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "riverbend", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``).
    A local session with neither gets a private folder; a cluster session
    without one is an error, because a machine-local folder is not visible to
    other executors and does not survive their loss.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # getCheckpointDir() returns a per-application sub-folder; write beside it.
        return os.path.dirname(root.rstrip("/")) if "/" in root else root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="riverbend-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/riverbend/{name}-{uuid.uuid4().hex[:12]}"
    return path


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh scratch folder as Parquet and read it back: cuts
    the lineage, survives the loss of executors, and every reader sees the same rows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``--py-files`` at runtime).

    Needed by operators whose Python code runs on executors (protobuf codec,
    stateful processors).  Zipped once per application and added with
    ``addPyFile``; also registered with cloudpickle to travel by value.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil
    import sys

    from pyspark import cloudpickle

    # The streaming Python runner (transformWithState) does not see files added
    # with addPyFile: send this package's functions and classes by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    stage = tempfile.mkdtemp(prefix="riverbend-pkg-")
    archive = shutil.make_archive(os.path.join(stage, "riverbend"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="riverbend")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
