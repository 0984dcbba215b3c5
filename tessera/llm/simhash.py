"""SimHash near-duplicates: pigeonhole blocks over 64-bit fingerprints.

Fingerprints within ``distance`` bits share at least ``blocks - distance`` of
``blocks`` blocks whole, so close pairs meet in a join on one of the
combinations of that many blocks.  Every candidate's Hamming distance is
verified.  Equal fingerprints are one node.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, materialize
from tessera.llm.components import connected_components

#: Buckets up to this many fingerprints are joined in Spark; larger ones are cut into chunks.
SMALL_BUCKET = 48
CHUNK = 4096


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash as a signed integer: a bit is 1 if it is set in over half
    the XXH64 (seed 42) of the word shingles, repeats included."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-shingle].tolist()]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)]
    bits = np.zeros(64, dtype=np.int64)
    array = np.array(hashes, dtype="<u8")
    for k in range(0, len(array), 8192):
        part = array[k:k + 8192]
        bits += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(array), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 digest: bool = False) -> DataFrame:
    """``id, fp`` of every row and, with ``digest``, ``sha`` of its text."""
    python_tasks(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    sha = [F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha")] if digest else []
    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("fp"), *sha)


def block_keys(fp: Column, distance: int, blocks: int) -> list[Column]:
    """One key per combination of blocks that a close pair may share."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    keys = []
    for chosen in combinations(masks, blocks - distance):
        mask = sum(chosen)
        keys.append(fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))
    return keys


def _forest(values, distance: int):
    """Edges of a spanning forest of the values within ``distance`` bits: each
    value is held once against those that no edge has reached yet."""
    import numpy as np

    rest = np.array(values, dtype=np.int64)
    a, b = [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            v = queue.pop()
            near = np.bitwise_count((rest ^ v).view(np.uint64)) <= distance
            if near.any():
                found = rest[near]
                a += [v] * len(found)
                b += found.tolist()
                queue += found.tolist()
                rest = rest[~near]
    return a, b


def fingerprint_links(fps: DataFrame, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """Edges ``a, b`` that connect what pairs within ``distance`` bits connect.

    ``fps`` has distinct ``fp``.  Small buckets give every verified pair; a
    bucket with more than ``SMALL_BUCKET`` fingerprints is cut into chunks, and
    every pair of chunks gives a spanning forest of its links, which leaves
    connectivity as it is and never lists a group's pairs.
    """
    keys = block_keys(F.col("fp"), distance, blocks or distance + 2)
    table = fps.select("fp", F.posexplode(F.array(*keys)).alias("t", "key"))
    sizes = table.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(table.join(sizes, ["t", "key"]), "simhash_buckets")

    small = met.where(F.col("n") <= SMALL_BUCKET)
    other = small.select("t", "key", F.col("fp").alias("b"))
    pairs = (small.select("t", "key", F.col("fp").alias("a")).join(other, ["t", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
             .select("a", "b"))

    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks)
    big = (met.where(F.col("n") > SMALL_BUCKET).withColumn("c", own)
           .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
           .select("t", "key", F.least("c", "o").alias("lo"), F.greatest("c", "o").alias("hi"), "fp"))

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = _forest(pdf["fp"].to_numpy(), distance)
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return pairs.unionByName(big.groupBy("t", "key", "lo", "hi").applyInPandas(forest, "a long, b long")).distinct()


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  distance: int = 4, blocks: int | None = None, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fp`` (signed 64 bits),
    ``component_id`` (smallest id reachable over links, itself included),
    ``kept`` (the id is the component's) and, with ``digest``, ``text_sha256``.

    Null and empty texts have fingerprint 0, which links like any other; texts
    shorter than a shingle are hashed whole.  Rows repeated under one id are
    kept or dropped together.  Null ids come after all others: a component of
    null ids only has a null ``component_id`` and is kept.  An empty table
    gives an empty result; other columns are not looked at.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle, digest), "simhash_fps")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep")), "simhash_nodes")
    links = fingerprint_links(nodes.select("fp"), distance, blocks)
    comp = connected_components(links).select(F.col("node").alias("fp"), "component")
    marked = nodes.join(comp, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    marked = materialize(marked, "simhash_marked")
    least = marked.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_fp = marked.join(least, "component").select("fp", "component_id")
    return (prints.join(by_fp, "fp", "left")
            .select(F.col("id").alias(id_col), "fp", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
                    *([F.col("sha").alias("text_sha256")] if digest else [])))
