import numpy as np
import pytest

from tessera.llm.embedding_dedup import budgets, block_cuts, embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id string"


def plain(rows, cosine=0.95):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v, dtype=np.float32).astype(float)
            fine[i] = x / np.linalg.norm(x)
    links = {i: [] for i, _ in rows}
    for a in fine:
        for b in fine:
            if a < b and len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] >= cosine:
                links[a].append(b)
                links[b].append(a)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links[i]), min(seen, default=i, key=lambda x: (x is None, x)), )
    return out


def compare(spark, rows, **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "c", "c") for i, v in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(df, **kw).collect()}
    assert got == plain(rows, kw.get("cosine", 0.95))
    return got


def clustered(seed, n, dim, noise):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        if k % 3 == 0 or not rows:
            v = r.standard_normal(dim)
        else:
            v = np.array(rows[r.integers(len(rows))][1]) + noise * r.standard_normal(dim)
        rows.append((k, [float(x) for x in np.float32(v / np.linalg.norm(v))]))
    return rows


@pytest.mark.parametrize("dim, noise, blocks", [(64, 0.03, 4), (64, 0.04, 8), (16, 0.06, 4), (3, 0.05, 4), (1, 0.5, 4)])
def test_against_all_pairs(spark, dim, noise, blocks):
    compare(spark, clustered(dim, 220, dim, noise), blocks=blocks)


def test_slabs_are_cut_into_chunks(spark, monkeypatch):
    import tessera.llm.embedding_dedup as m
    monkeypatch.setattr(m, "CHUNK", 16)
    r = np.random.default_rng(3)
    hub = r.standard_normal(64)
    rows = clustered(5, 150, 64, 0.03) + [(500 + k, [float(x) for x in np.float32(hub + 0.08 * r.standard_normal(64))]) for k in range(120)]
    got = compare(spark, rows)
    assert max(n for n, _ in got.values()) > 50


def test_awkward_vectors(spark):
    one = [1.0] + [0.0] * 7
    rows = [(0, one), (1, [x * 5 for x in one]), (2, None), (3, [0.0] * 8), (4, [float("nan")] + one[1:]), (5, [float("inf")] + one[1:]),
            (6, [None] + one[1:]), (7, []), (8, one[:4]), (9, one), (10, [-x for x in one]), (11, [0.0, 1.0] + [0.0] * 6), (12, one), (14, [1e-30] * 8)]
    compare(spark, rows)


def test_repeated_rows_are_linked_vectors(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(1, v, 0, "", ""), (1, v, 0, "", ""), (2, v, 0, "", "")], SCHEMA)
    assert sorted(tuple(r) for r in embedding_dedup(df).collect()) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_repeated_and_null_ids_with_different_vectors(spark):
    r = np.random.default_rng(8)
    rows = []
    for k in range(160):
        v = r.standard_normal(8) if k % 3 == 0 or k < 3 else np.array(rows[r.integers(len(rows))][1]) + 0.1 * r.standard_normal(8)
        rows.append((None if k % 7 == 0 else k % 40, [float(x) for x in np.float32(v)]))
    rows += [(5, [1.0] + [0.0] * 7), (5, [0.0, 1.0] + [0.0] * 6), (61, [2.0] + [0.0] * 7), (62, [0.0, 3.0] + [0.0] * 6), (None, None), (None, None)]
    # rows by number, so that the plain version has one id per row
    x = [None if v is None else np.array(v) / np.linalg.norm(v) for _, v in rows]
    links = [[j for j in range(len(rows)) if j != i and x[i] is not None and x[j] is not None and x[i] @ x[j] >= 0.95] for i in range(len(rows))]
    want = []
    for i, (name, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        want.append((name, len(links[i]), low, name == low))
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA)
    got = [tuple(t) for t in embedding_dedup(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {n for i, n, *_ in got if i == 5} != {2}


def test_budgets_cover_the_whole_distance():
    for dim in (1, 3, 16, 64):
        assert budgets(dim, 4, 0.95).sum() >= 0.1 and block_cuts(dim, 4)[-1] == dim


def test_empty(spark):
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
