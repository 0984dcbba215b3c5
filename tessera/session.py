"""Session settings and the shared folder for lineage cuts and landing files."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins from measured shuffle
# sizes (broadcast below the threshold, sort-merge above, skewed partitions
# split); the session zone is pinned so that nothing in the models depends on
# the caller's zone (the models themselves never read it).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or return) a session with the library's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session.  Only a local session (tests, one machine) gets a
    private folder where it is unset; elsewhere executors would each write to
    a folder of their own, so a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and (sc := getattr(spark, "_sc", None)) is not None:
        path = sc.getCheckpointDir()
    if not path:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "tessera", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused folder of this application under the shared folder."""
    return os.path.join(_scratch_root(spark), kind, uuid.uuid4().hex)


#: Shuffle files of a query go when it ends, not when the driver happens to
#: collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """For writes whose result is read back: the shuffle files of each go
    with it, so what follows does not add to them on the disks."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df``, written once under ``scratch_path`` and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_tables: dict[str, list[str]] = {}


def scratch_table(spark: SparkSession, name: str) -> None:
    """Note a catalog table whose files are under ``scratch_path``."""
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application wrote under ``scratch_path``, and the
    catalog tables noted on it.  To be called when no frame that reads it is
    needed any more."""
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    drop_path(spark, _scratch_root(spark))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
