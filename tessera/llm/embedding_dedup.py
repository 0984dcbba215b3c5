"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors are turned by a fixed random rotation and split into blocks.  A
pair with cosine of at least ``c`` has a squared distance of at most
``2 - 2c``, so in one block at least it stays within that block's share of the
budget.  Each block is range-joined on its own: slabs of one radius along its
first axis, points of neighbouring slabs compared within the block.  Pairs
that a block finds are verified by their exact cosine, and counted in the
first block that finds them, so that the union has every pair once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, materialize, small_side
from tessera.llm.components import connected_components, local_roots

#: Points of one slab that are compared as one side; larger slabs are cut.
CHUNK = 16_384
TILE = 1024
SLACK = 1e-9


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return np.round(q * np.sign(np.diag(r)), 14)


def block_cuts(dim: int, blocks: int) -> list[int]:
    """Bounds of the blocks: as equal as ``dim`` allows, none empty."""
    blocks = min(blocks, dim)
    return [dim * k // blocks for k in range(blocks + 1)]


def budgets(dim: int, blocks: int, cosine: float) -> np.ndarray:
    """Squared-distance budget of each block, in proportion to its dimensions."""
    cuts = np.array(block_cuts(dim, blocks))
    return (2 - 2 * cosine) * np.diff(cuts) / dim * (1 + SLACK) + SLACK


def _units(arrays) -> np.ndarray:
    """The given vectors at length one."""
    x = np.stack([np.asarray(a, dtype=np.float64) for a in arrays])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _turned(x: np.ndarray, dim: int, seed: int) -> np.ndarray:
    r = rotation(dim, seed)
    # row by row sums of one fixed order: the same values in whatever batch a row comes
    return np.concatenate([(x[k:k + 256, None, :] * r[None]).sum(axis=-1) for k in range(0, len(x), 256)])


def slabs(reps: DataFrame, cosine: float, blocks: int, seed: int) -> DataFrame:
    """``id, cnt, dim, block, slab, v`` (the vector as given) per block."""
    kind = reps.schema["v"].dataType.simpleString()

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["v"].map(len)):
                y = _turned(_units(part["v"]), dim, seed)
                width = np.sqrt(budgets(dim, blocks, cosine))
                for b, start in enumerate(block_cuts(dim, blocks)[:-1]):
                    yield pd.DataFrame({"id": part["id"].to_numpy(), "cnt": part["cnt"].to_numpy(), "dim": dim, "block": b,
                                        "slab": np.floor(y[:, start] / width[b]).astype(np.int64), "v": part["v"].to_numpy()})

    return reps.mapInPandas(deal, f"id long, cnt long, dim int, block int, slab long, v {kind}")


def _pairs(a: np.ndarray, b: np.ndarray | None, ua: np.ndarray, ub: np.ndarray, block: int, cuts: list[int], most: np.ndarray, cosine: float):
    """Pairs ``(i, j)`` of the turned rows of ``a`` and ``b`` (of ``a`` with
    itself if ``b`` is None) that this block is the first to find, verified by
    the given vectors ``ua`` and ``ub``."""
    within = slice(cuts[block], cuts[block + 1])
    other = a if b is None else b
    fa, fo = a[:, within].astype(np.float32), other[:, within].astype(np.float32)
    na, no = (fa * fa).sum(1), (fo * fo).sum(1)
    for s in range(0, len(a), TILE):
        for t in range(s if b is None else 0, len(other), TILE):
            near = fa[s:s + TILE] @ fo[t:t + TILE].T
            near *= -2
            near += na[s:s + TILE, None]
            near += no[None, t:t + TILE]
            i, j = np.nonzero(near <= most[block] + 1e-5)
            i, j = i + s, j + t
            if b is None:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 65_536):
                p, q = i[k:k + 65_536], j[k:k + 65_536]
                d = a[p] - other[q]
                d *= d
                by_block = np.stack([d[:, u:v].sum(1) for u, v in zip(cuts, cuts[1:], strict=False)], axis=1)
                first = np.argmax(by_block <= most, axis=1)
                found = (by_block[:, block] <= most[block]) & (first == block) & ((ua[p] * ub[q]).sum(1) >= cosine)
                if found.any():
                    yield p[found], q[found]


def vector_links(points: DataFrame, cosine: float, blocks: int, seed: int) -> DataFrame:
    """``id, root, links``: per group of compared points, each linked point's
    links there (weighed by ``cnt``) and the root of its local component."""
    home = ["dim", "block", "slab"]
    sizes = materialize(points.groupBy(*home).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("n")), "emb_slabs")
    at = lambda k, name: small_side(sizes.select("dim", "block", (F.col("slab") - k).alias("slab"), F.col("n").alias(name)))
    p = (points.join(at(0, "n0"), home, "left").join(at(1, "up"), home, "left").join(at(-1, "down"), home, "left")
         .withColumn("c", F.pmod(F.xxhash64("id"), F.col("n0")).cast("int")))
    empty = "cast(array() as array<struct<s:bigint,g:int,lo:int,hi:int>>)"
    tiles = F.expr(
        "concat(transform(sequence(0, n0 - 1), o -> named_struct('s', slab, 'g', 0, 'lo', least(c, o), 'hi', greatest(c, o))), "
        f"if(up is null, {empty}, transform(sequence(0, up - 1), o -> named_struct('s', slab, 'g', 1, 'lo', c, 'hi', o))), "
        f"if(down is null, {empty}, transform(sequence(0, down - 1), o -> named_struct('s', slab - 1, 'g', 1, 'lo', o, 'hi', c))))")
    dealt = p.withColumn("tile", F.explode(tiles)).select("id", "cnt", "dim", "block", "slab", "c", "v", "tile.*")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, block, s, g, lo, hi = key
        cuts, most = block_cuts(dim, blocks), budgets(dim, blocks, cosine)
        if g == 0 and lo == hi:
            left = np.ones(len(pdf), dtype=bool)
        else:
            left = (pdf["c"] == lo).to_numpy() if g == 0 else (pdf["slab"] == s).to_numpy()
        pdf = pd.concat([pdf[left], pdf[~left]])
        n, k = len(pdf), int(left.sum())
        if k == 0 or n < 2 or (k == n and not (g == 0 and lo == hi)):
            return pd.DataFrame({"id": [], "root": [], "links": []}).astype("int64")
        units, cnt, ids = _units(pdf["v"]), pdf["cnt"].to_numpy(), pdf["id"].to_numpy()
        y = _turned(units, dim, seed)
        links = np.zeros(n, dtype=np.int64)

        def pairs():
            for i, j in _pairs(y[:k], y[k:] if k < n else None, units[:k], units[k:] if k < n else units, block, cuts, most, cosine):
                j = j + k if k < n else j
                np.add.at(links, i, cnt[j])
                np.add.at(links, j, cnt[i])
                yield i, j

        root = local_roots(n, pairs())
        met = links > 0
        return pd.DataFrame({"id": ids[met], "root": ids[root[met]], "links": links[met]})

    return dealt.groupBy("dim", "block", "s", "g", "lo", "hi").applyInPandas(compare, "id long, root long, links long")


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = 0.95, blocks: int = 4, seed: int = 11) -> DataFrame:
    """One row per row of ``vectors``: ``id_col, n_links, component_id, kept``.

    ``n_links`` counts the other vectors with a cosine of at least ``cosine``
    (between 0 and 1), ``component_id`` is the smallest id reachable over
    links, ``kept`` says that it is the row's own.  Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing;
    vectors of different length neither.  Equal vectors are compared once, as
    one point of that weight, so repeated rows are linked vectors like any
    others.  Ids are integers; rows of one id may have different vectors, each
    with its own links.  A row without an id links and is counted like others;
    its id is no component's smallest, a component of such rows only has a null
    ``component_id`` and all are kept.  An empty table gives an empty result.

    A slab is cut into chunks of at most about ``CHUNK`` points and every task
    compares two chunks in tiles; it returns one row per linked point, never
    pairs.
    """
    python_tasks(vectors.sparkSession, 2048)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    fine = F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", fine)
    good = rows.where("ok").select("id", "v")
    # a distinct vector is a node of its own; ids only tell at last which of a component's is the smallest
    reps = (good.groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("cnt"))
            .withColumn("id", F.monotonically_increasing_id()))
    reps = materialize(reps, "emb_reps")
    points = materialize(slabs(reps.select("id", "cnt", "v"), cosine, blocks, seed), "emb_points")
    found = materialize(vector_links(points, cosine, blocks, seed), "emb_links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    marks = materialize(reps.join(counts, "id", "left").join(comp.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "v", "least", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n"), F.coalesce("component", "id").alias("component")), "emb_marks")
    roots = marks.groupBy("component").agg(F.min("least").alias("root"))
    linked = good.join(marks.join(roots, "component").select("v", "n", "root"), "v").select("id", "n", "root")
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("root"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_links"), F.col("root").alias("component_id"),
        F.col("id").eqNullSafe(F.col("root")).alias("kept"))
