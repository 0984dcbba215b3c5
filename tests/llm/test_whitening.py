import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm.whitening import by_component, whiten
from tests.llm.tables import empty

VECS = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """(id, deviation, whitened rows, explained) by numpy, signs open."""
    use = [(i, v) for i, v in rows if v is not None and len(v) == 4 and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in use], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(((n * r - s) ** 2).sum()) for r in x]
    c = np.array(x - s / n, dtype=float)
    e, u = np.linalg.eigh(c.T @ c / n)
    return use, deviation, (c @ u / np.sqrt(e))[:, ::-1], (e / e.sum())[::-1]


def some(n=200):
    pick = random.Random(3)
    rows = [(k if k % 11 else None, [pick.gauss(0, 1) * (j + 1) + j for j in range(4)]) for k in range(n)]
    rows += [(5, rows[8][1]), (5, rows[9][1]), (300, None), (301, [1.0, None, 2.0, 3.0]), (302, [1.0, float("nan"), 2.0, 3.0]),
             (303, [float("inf"), 1.0, 1.0, 1.0]), (304, []), (305, [1.0, 2.0]), (306, [-float("inf")] * 4), (307, [3e38, 0.0, 0.0, 0.0])]
    return rows


def compare(rows, found):
    use, deviation, white, explained = plain([r for r in rows if r[0] != 307])
    got = sorted(found, key=lambda r: (str(r["vec_id"]), r["deviation"], r["whitened"][0]))
    assert len(got) == len(use)
    sign = np.sign(np.sum([r["whitened"] for r in got], axis=0))
    want = sorted(zip([i for i, _ in use], deviation, white.tolist(), strict=True), key=lambda w: (str(w[0]), w[1]))
    assert [(r["vec_id"], r["deviation"]) for r in got] == [w[:2] for w in want]
    key = lambda v: tuple(np.round(np.abs(v), 6))  # noqa: E731  rows of one id and deviation may come in any order
    assert sorted(key(r["whitened"]) for r in got) == sorted(key(w[2]) for w in want)
    assert len(sign) == 4 and all(np.allclose(r["explained"], explained) for r in got)
    z = np.array([r["whitened"] for r in got])
    assert np.abs(z.T @ z / len(z) - np.eye(4)).max() < 1e-9 and all(0 <= r["identity_error"] < 1e-9 and r["n"] == len(use) for r in got)


def test_equals_numpy(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in some()], VECS)
    for name in ("id", "x", "v", "g", "n", "place", "centred", "whitened", "pos", "dim"):
        df = df.withColumn(name, F.lit("clash"))
    compare(some(), whiten(df).collect())


def test_many_blocks_and_panels(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in some(60)], VECS)
    compare(some(60), whiten(df, block_entries=40, panel_blocks=3).collect())


def test_columns_of_the_matrix_are_cut_too(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 3)) @ rng.standard_normal((3, 1100))
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], VECS)
    got = whiten(df, components=2).collect()
    z = np.array([r["whitened"] for r in got])
    assert z.shape == (40, 2) and np.abs(z.T @ z / 40 - np.eye(2)).max() < 1e-6


def test_rows_by_component(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in some(30)], VECS)
    rows = by_component(whiten(df, components=3)).collect()
    n = rows[0]["n"]
    assert len(rows) == 3 * n and {r["component"] for r in rows} == {1, 2, 3}
    share = {r["component"]: r["explained"] for r in rows}
    assert share[1] > share[2] > share[3] > 0


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0], 0) for k in range(5)], VECS)
    assert [(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in whiten(same).collect()] == [(5, 0, [], 0.0)] * 5
    flat = spark.createDataFrame([(k, [float(k), 2.0], 0) for k in range(5)], VECS)
    assert {len(r["whitened"]) for r in whiten(flat).collect()} == {1}
    none = whiten(empty(same))
    assert none.count() == 0 and by_component(none).count() == 0
    assert whiten(same.withColumn("embedding", F.lit(None).cast("array<float>"))).count() == 0
