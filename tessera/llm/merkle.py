"""Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf; the leaves of a group (here: a language) form a tree in
which each run of ``fanout`` consecutive nodes becomes the hash of their
digests, and the groups' roots form a last tree of the same kind.  Leaves are
cut into aligned blocks, a power of the fanout long.  A block hashes up to its
own root alone.  Then, round by round, the aligned teams of ``fanout`` blocks
(numbers that differ in one digit) swap the roots of the subtrees they stand
for: each member hashes the ancestor itself and keeps the others' roots as its
proof, so that after the last round every block holds the group's root and the
upper part of all its proofs, and nothing is sent down again.
"""

from __future__ import annotations

from collections.abc import Mapping
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, python_tasks, small_side
from tessera.llm.places import with_places

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Levels of the tree inside a block: blocks of 2 ** 9 leaves.
HEIGHT = 9
#: Rounds of the exchange between two lineage cuts.
CUT = 4


def field_text(value: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else bytes, ``:``, value."""
    s = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def levels(leaves: list[str], fanout: int, height: int) -> list[list[str]]:
    """The nodes of a block on every level, leaves first."""
    out = [leaves]
    for _ in range(height):
        below = out[-1]
        out.append([sha256("".join(below[k:k + fanout]).encode()).hexdigest() for k in range(0, len(below), fanout)])
    return out


def steps(nodes: list[str], fanout: int) -> list[str]:
    """For each node of a level, ``left|right``: its siblings' digests."""
    out = []
    for k in range(0, len(nodes), fanout):
        run = nodes[k:k + fanout]
        out += ["".join(run[:j]) + "|" + "".join(run[j + 1:]) for j in range(len(run))]
    return out


def fold(leaf: Column | str, proof: Column | str) -> Column:
    """The root that a leaf and its proof lead to (native)."""
    return F.aggregate(proof, F.col(leaf) if isinstance(leaf, str) else leaf,
                       lambda node, s: F.sha2(F.concat(F.substring_index(s, "|", 1), node, F.substring_index(s, "|", -1)), 256))


def _height(n: str, fanout: int) -> Column:
    """Levels above ``n`` nodes until one is left."""
    return F.expr(f"size(filter(sequence(0, 62), k -> power({fanout}D, k) < {n}))")


def _butterfly(blocks: DataFrame, fanout: int, kind: str) -> DataFrame:
    """``g, block, top, above``: the root of the block's group and the proof
    steps from the block's root to it, for ``g, block, n_blocks, node``.

    Block numbers are filled up to a power of the fanout with empty blocks
    (fewer than there are real ones, times the fanout less one), so that every
    team is whole; a subtree without a real block has a null node.
    """
    state = blocks.withColumn("rounds", _height("n_blocks", fanout)).withColumn("above", F.expr("array()").cast("array<string>"))
    reach = f"cast(power({fanout}D, rounds - 1) as bigint)"
    empty = (state.where(f"rounds > 0 and block < {reach}")
             .withColumn("block", F.explode(F.expr(f"filter(transform(sequence(1, {fanout - 1}), j -> block + j * {reach}), b -> b >= n_blocks)")))
             .withColumn("node", F.lit(None).cast("string")))
    state = materialize(state.unionByName(empty), f"{kind}_butterfly")
    last = state.agg(F.max("rounds")).first()[0] or 0
    for r in range(last):
        span = fanout ** r
        team = (state.where(f"rounds > {r}")
                .withColumn("digit", F.expr(f"(block div {span}L) % {fanout}"))
                .groupBy("g", "n_blocks", "rounds", (F.col("block") - F.col("digit") * span).alias("seat"))
                .agg(F.array_sort(F.collect_list(F.struct("digit", "block", "node", "above"))).alias("team")))
        swapped = team.withColumns({
            "nodes": F.expr("transform(team, m -> m.node)"),
            "ancestor": F.expr("if(exists(team, m -> m.node is not null), sha2(array_join(transform(team, m -> m.node), ''), 256), null)"),
        }).select("g", "n_blocks", "rounds", "ancestor", "nodes", F.explode("team").alias("m"))
        moved = swapped.select(
            "g", F.col("m.block").alias("block"), "n_blocks", F.col("ancestor").alias("node"), "rounds",
            F.expr("array_append(m.above, concat(array_join(slice(nodes, 1, int(m.digit)), ''), '|', "
                   "array_join(slice(nodes, int(m.digit) + 2, size(nodes)), '')))").alias("above"))
        state = moved.unionByName(state.where(f"rounds <= {r}"))
        if r % CUT == CUT - 1:
            state = materialize(state, f"{kind}_round")
    return state.where("block < n_blocks").select("g", "block", F.col("node").alias("top"), "above")


def _trees(leaves: DataFrame, order: list[str], keep: list[str], fanout: int, height: int, kind: str) -> DataFrame:
    """``g``, ``leaf`` and ``keep`` (strings) of ``leaves``, a written table
    (``g`` not null), with ``top``, the root of the tree over the leaves of the
    group by ``order``, and ``proof``, the steps to it.  A block's rows are all
    that a Python task holds."""
    python_tasks(leaves.sparkSession)
    size, names = fanout ** height, ["g", "leaf", *keep]
    placed = with_places(leaves, "g", order, kind)
    placed = materialize(placed.select(
        *names, F.expr(f"place div {size}L").alias("block"), F.expr(f"int(place % {size}L)").alias("at"),
        F.least(_height("n", fanout), F.lit(height)).alias("height"), F.expr(f"(n + {size - 1}L) div {size}L").alias("n_blocks")),
        f"{kind}_placed")

    def roots(rows: pd.DataFrame) -> pd.DataFrame:
        rows, first = rows.sort_values("at"), rows.iloc[0]
        node = levels(rows["leaf"].tolist(), fanout, int(first["height"]))[-1][0]
        return pd.DataFrame({"g": [first["g"]], "block": [first["block"]], "n_blocks": [first["n_blocks"]], "node": [node]})

    nodes = (placed.select("g", "block", "at", "leaf", "height", "n_blocks").groupBy("g", "block")
             .applyInPandas(roots, "g string, block long, n_blocks long, node string"))
    above = materialize(_butterfly(nodes, fanout, kind), f"{kind}_above")

    def proofs(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, up = rows.sort_values("at"), list(above["above"].iloc[0])
        tree = levels(rows["leaf"].tolist(), fanout, int(rows["height"].iloc[0]))
        each = [steps(level, fanout) for level in tree[:-1]]
        out = rows[names].copy()
        out["top"] = above["top"].iloc[0]
        out["proof"] = [[s[k // fanout ** h] for h, s in enumerate(each)] + up for k in range(len(rows))]
        return out

    return placed.groupBy("g", "block").cogroup(above.groupBy("g", "block")).applyInPandas(
        proofs, ", ".join(f"{c} string" for c in names) + ", top string, proof array<string>")


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
                    found: Mapping[str, Column] | None = None, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``leaf``, ``subroot`` (its
    group's root), ``root`` and ``proof``, an array of steps ``left|right``
    (the siblings' digests on either side) from the leaf to the root; with
    ``found``, columns as they are found later, also ``found_leaf``, the leaf
    they make, ``folded_root``, what that and the proof lead to, and
    ``verified``, whether it is the root.

    A leaf is the SHA-256 of its ``fields``, null ones marked; groups ascend by
    their text's bytes, the null group first; leaves by id, null ids first,
    then by digest, so equal rows are leaves side by side and each has a proof
    of its own.  A group of one leaf has the leaf as its root, one group's root
    is the root; the proof of a lone row is empty.  An empty table gives an
    empty result; columns that are not named are not looked at.

    Leaves (digests and ids, no texts) are dealt out by range and then by
    block; a group or an id of any size is spread over blocks.
    """
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    found, kind = dict(found or {}), "merkle"
    now = {c: docs[c] for c in fields}
    base = docs.select(
        F.concat(F.lit("g"), F.when(docs[group_col].isNull(), "").otherwise(F.concat(F.lit("="), docs[group_col].cast("string")))).alias("g"),
        docs[id_col].alias("id"), leaf_hash([now[c] for c in fields]).alias("leaf"),
        (leaf_hash([found.get(c, now[c]) for c in fields]) if found else F.lit(None).cast("string")).alias("seen"))
    # a found leaf is only sent on where it differs
    base = materialize(base.withColumns({"seen": F.when(F.col("seen") != F.col("leaf"), F.col("seen")),
                                         "name": F.col("id").cast("string")}), f"{kind}_leaves")
    within = _trees(base, ["id", "leaf"], ["name", "seen"], fanout, height, kind)
    within = materialize(within.withColumn("id", F.col("name").cast(docs.schema[id_col].dataType)), f"{kind}_within")
    subroots = materialize(within.select("g", "top").distinct().select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("top").alias("leaf")), f"{kind}_subroots")
    over = _trees(subroots, ["key"], ["key"], fanout, height, f"{kind}_over")
    over = small_side(materialize(over.select(F.col("key").alias("g"), F.col("top").alias("root"), F.col("proof").alias("up")), f"{kind}_up"))
    out = within.join(over, "g").select(
        F.col("id").alias(id_col), "leaf", F.col("top").alias("subroot"), "root", F.concat("proof", "up").alias("proof"),
        F.coalesce("seen", "leaf").alias("found_leaf"))
    if not found:
        return out.drop("found_leaf")
    out = out.withColumn("folded_root", fold("found_leaf", "proof"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
