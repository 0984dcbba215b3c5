"""Bronze ingest of day-partitioned landing folders as an ``availableNow`` stream.

The vendors drop one folder per ingest day (``<feed>/<day>/...``).  A file
stream over ``<feed>/*`` with a checkpoint picks up exactly the files not
ingested before, appends them to the bronze table and stops -- a re-run after
a failure (or a lost executor) resumes from the checkpoint without landing a
file twice.  The parsing is the batch readers' (same schemas / DDLs), so the
streamed bronze equals the batch bronze of the same days.

A page of a JSON array that does not parse is kept as one row marked
``malformed``, in a partition of its own: it can be counted, and
``read_ingested`` leaves it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.landing import parsed_pages


def _source(spark: SparkSession, feed_dir: str, kind: str, schema, files: int) -> DataFrame:
    path = feed_dir.rstrip("/") + "/*"
    r = spark.readStream.option("maxFilesPerTrigger", files)
    if kind == "json_array":
        rows = parsed_pages(r.text(path), schema).selectExpr("explode_outer(records) AS r", "records IS NULL AS malformed")
        # an empty page is a good page without records
        return rows.filter("malformed OR r IS NOT NULL").select("r.*", "malformed")
    if kind == "csv":
        rows = r.schema(schema).option("header", True).csv(path)
    elif kind == "json_lines":
        rows = r.schema(schema).json(path)
    elif kind == "parquet":
        rows = r.schema(schema).parquet(path)
    else:
        raise ValueError(f"unknown landing format {kind!r}")
    return rows.withColumn("malformed", F.lit(False))


def _ingested(spark: SparkSession, bronze_path: str) -> dict[bool, int]:
    """Rows and malformed pages in the sink so far (two partitions' footers)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(bronze_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return {}
    table = spark.read.schema("malformed boolean").parquet(bronze_path)
    return {r["malformed"]: r["count"] for r in table.groupBy("malformed").count().collect()}


def read_ingested(spark: SparkSession, bronze_path: str, schema: T.StructType | str) -> DataFrame:
    """The records that ``ingest_feed`` has appended."""
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*declared.fields, T.StructField("malformed", T.BooleanType())])
    return spark.read.schema(full).parquet(bronze_path).filter("NOT malformed").drop("malformed")


def ingest_feed(spark: SparkSession, feed_dir: str, kind: str, schema: T.StructType | str,
                bronze_path: str, checkpoint: str, files_per_batch: int = 1000) -> dict[str, int]:
    """Append every not-yet-ingested landing file of one feed to its bronze
    table, at most ``files_per_batch`` files a batch; returns the ``rows`` and
    ``malformed_pages`` that this run added, counted in the sink (progress
    reports are kept for the last batches only)."""
    before = _ingested(spark, bronze_path)
    (_source(spark, feed_dir, kind, schema, files_per_batch)
     .writeStream.format("parquet").partitionBy("malformed")
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True)
     .start(bronze_path).awaitTermination())
    after = _ingested(spark, bronze_path)
    return {name: after.get(bad, 0) - before.get(bad, 0) for name, bad in (("rows", False), ("malformed_pages", True))}
