"""The corpus pipeline: quality, exact and near duplicates, mixing, tokens.

``STAGES`` are ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written and read again as the next one's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.mixing import mix_documents
from tessera.llm.quality import ACCEPT, score_column, train
from tessera.llm.queries import DISTANCE, SHINGLE
from tessera.llm.sentencepiece import encode
from tessera.llm.sieve import passes, sieve_of, stays
from tessera.llm.simhash import simhash_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry classifier accepts.  Null and empty
    texts have a score like any other; repeated rows are judged alike."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score_column(F.col("text"), model) >= ACCEPT)


def _without(docs: DataFrame, judged: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows that are not kept.  A row is known by its id
    and the digest of its text, since ids may be null or stand on several
    texts.  Rows that pass the sieve of what goes stay where they are; only the
    few that it holds back are joined, so texts are not sent about."""
    lost = judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_sha"))
    gone = materialize(lost.distinct(), name)
    sha = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    sieve = sieve_of(gone.select(F.xxhash64("gone_id", "gone_sha").alias("key")), "key", f"{name}_sieve")
    held = passes(docs, F.xxhash64(docs["doc_id"], sha), sieve)
    sha = F.unhex(F.sha2(F.coalesce(held["text"], F.lit("")), 256))
    left = held.join(gone, held["doc_id"].eqNullSafe(gone["gone_id"]) & (sha == gone["gone_sha"]), "left_anti")
    sha = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    return stays(docs, F.xxhash64(docs["doc_id"], sha), sieve).unionByName(left)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts: the one with the largest id.
    A null text is an empty one, a null id the smallest; rows that repeat under
    the id that stays all stay (a corpus sent twice under its ids is not folded)."""
    return _without(docs, exact_dedup(docs, digest=True), "exact_gone")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the smallest id.
    Null and empty texts are one group; a null id goes if its group has another;
    rows that repeat under the id that stays all stay."""
    return _without(docs, simhash_dedup(docs, shingle=SHINGLE, distance=DISTANCE, digest=True), "simhash_gone")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: every document as often as it is taken.  A null
    source is a source; texts without words get their source's whole copies;
    repeated rows are taken alike."""
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, source, ``n_pieces`` and the piece ids of every document, in
    any number of rows and under any id; null and empty texts have no pieces."""
    return encode(docs).select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mixing), ("sentencepiece", tokens)]

#: No SQL: the classifier, SimHash and the encoder are not SQL.  tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
