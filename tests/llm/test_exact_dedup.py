import hashlib

from tessera.llm.exact_dedup import exact_dedup
from tests.llm.tables import awkward, documents, empty


def plain(rows):
    classes = {}
    for i, t, *_ in rows:
        classes.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = classes[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_awkward_rows(spark):
    long = "word " * 5000
    df, rows = awkward(spark, ["a b c", "a b c", "a b d", long + "x", long + "y", long + "x", "A b c", "a b c ", "é", "é"])
    assert rows_of(exact_dedup(df, digest=True)) == plain(rows)


def test_same_prefix_and_length_differ(spark):
    rows = [(k, "p" * 300 + str(k % 4)) for k in range(40)]
    got = rows_of(exact_dedup(documents(spark, rows), digest=True))
    assert got == plain(rows)
    assert sum(r[3] for r in got) == 4


def test_wide_survivors_take_the_other_way(spark, monkeypatch):
    import tessera.llm.exact_dedup as m
    monkeypatch.setattr(m, "BROADCAST_ROWS", 1)
    rows = [(k, f"text {k // 3}") for k in range(60)] + [(99, "alone in its length")]
    assert rows_of(m.exact_dedup(documents(spark, rows), digest=True)) == plain(rows)


def test_empty(spark):
    df = exact_dedup(empty(documents(spark, [(1, "a")])))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept"] and df.count() == 0
