import random
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import tessera.llm.sieve as sieve
from tessera.llm.substring_dedup import least, names_of, substring_dedup
from tests.llm.tables import awkward, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    split = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    rank = lambda i: float("-inf") if i is None else i
    low = {}
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            low[k] = min(low.get(k, float("inf")), rank(i))
    out = []
    for i, w in split:
        gone = {q for p in range(len(w) - window + 1) if low[tuple(w[p:p + window])] < rank(i) for q in range(p, p + window)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, window):
    return sorted((tuple(r)[:4] for r in substring_dedup(df, window=window).collect()), key=str)


@pytest.mark.parametrize("window", [2, 5, 8, 50])
def test_equals_brute_force(spark, window):
    pick = random.Random(window)
    words = ["a", "b", "ü", "d d", "e"] if window < 50 else [f"w{k}" for k in range(400)]
    texts = [pick.choice([" ", "\n", "\t  "]).join(pick.choices(words, k=pick.randrange(0, 3 * window))) for _ in range(60)]
    shared = " ".join(pick.choices(words, k=2 * window))
    texts += [f"{texts[k]} {shared} {texts[k + 1]}" for k in range(12)] + [texts[3]] * 4 + [shared + " x", " ".join(shared.split()[:window])]
    texts += [" ".join(shared.split()[:window - 1])]
    df, rows = awkward(spark, texts)
    want = plain(rows, window)
    assert got(df, window) == want
    assert sum(w[2] for w in want) > 0


def test_rows_of_one_id_take_nothing_from_each_other(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(4, text), (4, text), (4, "x " + text), (None, text + " y"), (2, text + " z"), (9, None)]
    assert got(documents(spark, rows), 50) == plain(rows, 50)


def test_a_long_text_and_a_passage_in_many(spark):
    pick = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(55))
    rows = [(k, f"a{k} b{k} {passage} c{k}") for k in range(300)]
    rows.append((1000, " ".join(f"u{pick.randrange(10**6)}" for _ in range(100_000)) + " " + passage))
    result = got(documents(spark, rows), 50)
    assert result == plain(rows, 50)
    assert [r[2] for r in result].count(55) == 300


def test_removed_runs(spark):
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(1, text), (2, f"x {' '.join(text.split()[:6])} y {' '.join(text.split()[8:16])} z")]
    found = {r["doc_id"]: [(a, b) for a, b in r["removed"]] for r in substring_dedup(documents(spark, rows), window=5).collect()}
    assert found == {1: [], 2: [(1, 7), (8, 16)]}


def test_empty(spark):
    df = substring_dedup(empty(documents(spark, [(1, "a")])))
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"] and df.count() == 0
    with pytest.raises(ValueError):
        substring_dedup(df, window=1)


def test_names_and_least():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 3, 200).astype(np.uint64)
    for size in (1, 2, 5, 25):
        names = names_of(one, size)
        seen = {}
        for p in range(len(one) - size + 1):
            assert seen.setdefault(names[p], tuple(one[p:p + size])) == tuple(one[p:p + size])
        assert len(seen) == len({tuple(one[p:p + size]) for p in range(len(one) - size + 1)})
    for span in (1, 2, 3, 26):
        at = least(one, span)
        assert all(at[p] == p + int(np.argmin(one[p:p + span])) for p in range(len(one) - span + 1))


def test_the_sieve_lets_every_key_through(spark, monkeypatch):
    rows = spark.range(4000).select(F.col("id").alias("doc"), F.when(F.col("id") % 50 != 0, F.col("id")).alias("key"))
    keys = rows.where("key % 7 = 3").select("key")
    for slots in (1 << 18, 3):
        monkeypatch.setattr(sieve, "SLOTS", slots)
        s = sieve.sieve_of(keys, "key", "test_sieve")
        through, behind = sieve.passes(rows, F.col("key"), s), sieve.stays(rows, F.col("key"), s)
        assert through.columns == behind.columns == rows.columns and s.count() <= slots
        assert through.join(keys, "key", "left_semi").count() == keys.count() and behind.join(keys, "key", "left_semi").count() == 0
        assert through.count() + behind.count() == 4000
        if slots > 3:
            assert through.count() < keys.count() + 50
