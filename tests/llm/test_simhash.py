import random
import re

import xxhash

from tessera.llm.components import connected_components
from tessera.llm.simhash import fingerprint, fingerprint_links, simhash_dedup
from tests.llm.tables import awkward, documents, empty


def plain_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    sh = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_is_the_plain_one():
    r = random.Random(3)
    for text in ["", " ", "a", "A b\tc", "Ä ß a b", "x y z w", "x y z w v"] + [
            " ".join(r.choice(["Foo", "bar", "é", "b\u00a0c", "d"]) for _ in range(r.randrange(1, 300))) for _ in range(30)]:
        assert fingerprint(text) % (1 << 64) == plain_fp(text), text


def test_documents_against_all_pairs(spark):
    r = random.Random(5)
    base = [" ".join(r.choice("abcdefghij") * 3 for _ in range(120)) for _ in range(12)]
    texts = []
    for b in base:
        for k in range(6):
            w = b.split()
            for _ in range(k):
                w[r.randrange(len(w))] = "new"
            texts.append(" ".join(w))
    df, rows = awkward(spark, texts)
    got = simhash_dedup(df).collect()
    assert len(got) == len(rows)
    fps = {}
    for i, t, *_ in rows:
        fps.setdefault(plain_fp(t), []).append(i)
    nodes = list(fps)
    comp = plain_components(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for f, ids in fps.items():
        for i in ids:
            if i is not None:
                least[comp[f]] = min(least.get(comp[f], i), i)
    text_of = {i: t for i, t, *_ in rows}
    for x in got:
        f = plain_fp(text_of[x.doc_id])
        assert x.fp % (1 << 64) == f
        assert x.component_id == least.get(comp[f])
        assert x.kept == (x.doc_id == x.component_id)


def test_large_buckets_and_random_bits(spark):
    r = random.Random(9)
    values = {r.getrandbits(64) for _ in range(300)}
    hub = r.getrandbits(64)
    for _ in range(400):  # a chain of close fingerprints shares its blocks: a bucket beyond the small ones
        hub ^= 1 << r.randrange(12)
        values.add(hub ^ (1 << r.randrange(64) if r.random() < .3 else 0))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    links = fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    pairs = [(a.a, a.b) for a in links.collect()]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in pairs)
    every = [(a, b) for k, a in enumerate(signed) for b in signed[k + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= 4]
    want = plain_components(signed, every)
    assert plain_components(signed, pairs) == want
    got = {x.node: x.component for x in connected_components(links).collect()}
    assert {v: got.get(v, v) for v in signed} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100)] + [(1000, k) for k in range(1001, 1050)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(101)} | {k: 1000 for k in range(1000, 1050)}


def test_empty(spark):
    assert simhash_dedup(empty(documents(spark, [(1, "a")]))).count() == 0
