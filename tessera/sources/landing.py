"""Bronze readers (CSV, JSON lines, pages of JSON arrays, parquet) and the
writers that land feeds in those formats.

Readers never infer a schema from the data when one is declared: inference is
an extra full pass over the landing files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- readers -------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header.  With a declared schema nothing is read to plan the
    scan, and a file whose header has other names is an error; without one
    every column is a string."""
    r = spark.read.option("header", True)
    return r.schema(schema).option("enforceSchema", False).csv(path) if schema is not None else r.csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def parsed_pages(text: DataFrame, element_ddl: str) -> DataFrame:
    """``records`` of every text line, which is one page: a JSON array of
    records.  NULL where the page is malformed."""
    return text.select(F.from_json(F.col("value"), f"array<struct<{element_ddl}>>").alias("records"))


def read_json_array(spark: SparkSession, path: str, element_ddl: str) -> DataFrame:
    """Pages of JSON arrays, one row per record; malformed pages yield none
    (``malformed_pages`` counts them)."""
    return parsed_pages(spark.read.text(path), element_ddl).selectExpr("inline(records)")


def malformed_pages(spark: SparkSession, path: str, element_ddl: str) -> DataFrame:
    """One row ``value``: the pages under ``path`` that are no JSON array."""
    return parsed_pages(spark.read.text(path), element_ddl).agg(
        F.count_if(F.col("records").isNull()).cast("bigint").alias("value"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- writers (landing side) -------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def write_raw_csv(lines: DataFrame, header: str, path: str) -> None:
    """Land ready-made CSV lines (one string column), a header in every file:
    what a vendor sends who does not quote.  Nothing is shuffled."""
    def with_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [header]})
        for b in batches:
            yield pd.DataFrame({"value": b.iloc[:, 0]})

    lines.mapInPandas(with_header, "value string").write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_array_pages(df: DataFrame, path: str, page_rows: int = 500) -> None:
    """Land ``df`` as pages of at most ``page_rows`` records per text line.

    Records are rendered to JSON on the JVM (``to_json``); pages are cut per
    partition in pandas -- no shuffle and no group larger than one page.
    """
    docs = df.select(F.to_json(F.struct(*df.columns)).alias("doc"))

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[str] = []
        for b in batches:
            rest += b["doc"].tolist()
            full = len(rest) - len(rest) % page_rows
            if full:
                yield pd.DataFrame({"value": ["[" + ",".join(rest[k:k + page_rows]) + "]" for k in range(0, full, page_rows)]})
                rest = rest[full:]
        if rest:
            yield pd.DataFrame({"value": ["[" + ",".join(rest) + "]"]})

    docs.mapInPandas(pages, "value string").write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
