import re
from collections import defaultdict

import pytest

from tessera.llm import mixing
from tessera.llm.mixing import mix, mix_documents, source_targets
from tests.llm.tables import awkward, documents, empty


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while True:
        total = sum(w[s] for s in free)
        share = {s: left * w[s] / total for s in free} if total else {}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over


def check(rows, df):
    got = df.collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want = plain_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        whole = r.target / r.source_size if r.source_size else 0
        assert int(whole) <= r.copies <= int(whole) + 1 or abs(r.copies - whole) < 1e-9
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1e-6, (s, taken[s], want[s])
    return got


def test_awkward_rows(spark):
    df, rows = awkward(spark, ["a b", "c d e f", "", "x", "y z w", "q " * 50, "one two three"])
    check(rows, mix(df))


def test_targets_hit_within_a_document_and_reruns_agree(spark):
    rows = [(k, "w " * (1 + k * 7 % 40), None if k % 11 == 0 else f"s{k % 4 if k % 3 else 0}") for k in range(1500)]
    df = documents(spark, rows)
    a = sorted(tuple(r) for r in check(rows, mix(df, fan_in=8)) if r.source is not None)
    b = sorted(tuple(r) for r in mix(df.repartition(5), fan_in=8).collect() if r.source is not None)
    assert a == b


def test_expectation_is_kept(spark):
    rows = [(k, "w " * (1 + k % 9), "a" if k % 2 else "b") for k in range(400)]
    df = documents(spark, rows)
    n = defaultdict(list)
    for seed in range(6):
        for r in mix(df, seed=seed).collect():
            n[r.source].append(r.copies - r.target / r.source_size)
    for deviations in n.values():
        assert abs(sum(deviations) / len(deviations)) < 0.05


def test_caps_bind(spark):
    rows = [(0, "a " * 10, "a"), (1, "b " * 10, "b"), (2, "c " * 1000, "c")]
    t = {r.source: r.target for r in source_targets(
        spark.createDataFrame([(s, words(x)) for _, x, s in rows], "source string, size long")).collect()}
    assert t == pytest.approx({"a": 30, "b": 30, "c": 960})


def test_small_sources_come_near_their_targets(spark):
    got = mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    misses = [abs(taken[s] - target[s]) / largest[s] for s in target]
    assert max(misses) < 0.6 and sum(misses) / len(misses) < 0.15


def test_repeats_beyond_one_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SPREAD", 7)
    rows = [(None, "a b", "x")] * 30 + [(5, "c d e", "x")] * 7 + [(6, "f", "y")] * 8 + [(k, "g h i j", "y") for k in range(10, 40)]
    got = check_counts(rows, mix(documents(spark, rows)))
    assert got[(None, "x", 2)][0] == 30 and got[(5, "x", 3)][0] == 7 and got[(6, "y", 1)][0] == 8


def check_counts(rows, df):
    """Rows and copies by (id, source, size); rows of one of these are taken alike."""
    n, copies = defaultdict(int), defaultdict(set)
    for r in df.collect():
        n[(r.doc_id, r.source, r["size"])] += 1
        copies[(r.doc_id, r.source, r["size"])].add(r.copies)
    want = defaultdict(int)
    for i, t, s in rows:
        want[(i, s, words(t))] += 1
    assert n == want and all(len(c) == 1 for c in copies.values())
    return {k: (n[k], next(iter(copies[k]))) for k in n}


def test_mixed_documents_are_the_rows_taken(spark):
    rows = [(k, "w " * (1 + k % 5) + str(k), f"s{k % 3}") for k in range(60)]
    df = documents(spark, rows)
    copies = {r.doc_id: r.copies for r in mix(df).collect()}
    mixed = mix_documents(df)
    assert mixed.columns == df.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
        assert r.text == rows[r.doc_id][1]
    assert got == {k: c for k, c in copies.items() if c}


def test_empty(spark):
    df = empty(documents(spark, [(1, "a")]))
    assert mix(df).count() == 0 and mix_documents(df).count() == 0
