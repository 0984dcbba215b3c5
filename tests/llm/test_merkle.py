import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tessera.llm.merkle import merkle_manifest
from tests.llm.tables import DOCS, empty

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(nodes, fanout):
    """Root, and of each node its steps (digests to the left, to the right)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, a in enumerate(at):
            low = a - a % fanout
            steps[k].append((nodes[low:a], nodes[a + 1:low + fanout]))
            at[k] = a // fanout
        nodes = [h("".join(nodes[k:k + fanout])) for k in range(0, len(nodes), fanout)]
    return nodes[0], steps


def plain(rows, fanout, tampered):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        done[g] = members, *tree([leaf_of(r) for r in members], fanout)
    root, upper = tree([done[g][1] for g in order], fanout)
    out = []
    for g, up in zip(order, upper, strict=True):
        members, subroot, steps = done[g]
        for r, own in zip(members, steps, strict=True):
            node = leaf_of(tampered(r))
            for left, right in own + up:
                node = h("".join(left) + node + "".join(right))
            proof = h("".join("".join(left + right) for left, right in own + up))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def bad(i):
    return i is not None and crc32(str(i).encode()) % 7 == 0


def tampered(r):
    return {**r, "n_chars": r["n_chars"] + 1} if bad(r["doc_id"]) and r["n_chars"] is not None else r


def got(df, fanout, height):
    hit = F.pmod(F.crc32(df["doc_id"].cast("string").cast("binary")), F.lit(7)) == 0
    m = merkle_manifest(df, fanout=fanout, height=height, found={"n_chars": F.when(hit, df["n_chars"] + 1).otherwise(df["n_chars"])})
    m = m.withColumn("proof", F.sha2(F.translate(F.array_join("proof", ""), "|", ""), 256))
    return sorted((tuple(r) for r in m.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows], DOCS)


@pytest.mark.parametrize("fanout, height", [(2, 1), (2, 9), (3, 1), (5, 2)])
def test_equals_the_plain_tree(spark, fanout, height):
    pick = random.Random(fanout * 10 + height)
    rows = [{"doc_id": None if k % 17 == 0 else k // 2 if k % 13 == 0 else k, "text": pick.choice([None, "", "é" * 3, f"t{k}"]),
             "lang": pick.choice(["en", "en", "en", "de", None, "", "é"]), "source": pick.choice([None, "s-1", "-"]),
             "n_chars": pick.choice([None, 0, -4, 7])} for k in range(90)]
    rows += [rows[5]] * 3 + [{**rows[3], "lang": "alone"}]
    df = table(spark, rows)
    for name in ("g", "leaf", "block", "at", "height", "n", "place", "top", "proof", "id", "name", "seen", "root"):
        df = df.withColumn(name, F.lit("clash"))
    want = plain(rows, fanout, tampered)
    assert got(df, fanout, height) == want
    assert {w[-1] for w in want} == {True, False}


def test_one_row_and_none(spark):
    row = {"doc_id": 5, "text": "x", "lang": "en", "source": None, "n_chars": 1}
    df = table(spark, [row])
    assert got(df, 2, 2) == plain([row], 2, tampered)
    assert got(empty(df), 2, 2) == []


def test_a_proof_is_checked_and_a_run_has_two_nodes(spark):
    df = table(spark, [{"doc_id": k, "text": f"t{k}", "lang": "en", "source": "s", "n_chars": 1} for k in range(20)])
    seen = merkle_manifest(df, height=2, found={"text": F.when(df["doc_id"] == 7, "other").otherwise(df["text"])})
    assert [r["doc_id"] for r in seen.where("not verified").collect()] == [7]
    with pytest.raises(ValueError):
        merkle_manifest(df, fanout=1)
