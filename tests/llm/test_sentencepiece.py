import os
import random

import pytest

from tessera.llm.piece_model import BYTE, CONTROL, NORMAL, UNKNOWN, PieceModel
from tessera.llm.sentencepiece import MODEL, DoubleArray, Unigram, decode, encode
from tests.llm.tables import awkward, documents, empty

MARK = "▁"


def toy(r=None, prefix=True, with_bytes=True):
    r = r or random.Random(1)
    words = {MARK, "a", "b", "c", MARK + "a", "ab", "abc", "bc", "ca", MARK + "ab", "aa", "aaa", MARK * 2, "日", "日本", "é"}
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)] if with_bytes else []
    return PieceModel(pieces + [(w, -float(r.randrange(1, 9)), NORMAL) for w in sorted(words)], prefix, False)


def plain(model, text):
    """Best score and path of the whole marked text by the plain recursion."""
    u = Unigram(model)
    x = u.mark(text)
    score = {t: s for t, s, k in model.pieces if k == NORMAL}
    number = {t: k for k, (t, _, _) in enumerate(model.pieces)}
    low = min(score.values()) - 10
    best = [0.0] + [-1e300] * len(x)
    back = [None] * (len(x) + 1)
    for i in range(len(x)):
        for n in range(1, len(x) - i + 1):
            s = score.get(x[i:i + n], low if n == 1 else None)
            if s is not None and best[i] + s > best[i + n]:
                best[i + n], back[i + n] = best[i] + s, x[i:i + n]
    out, at = [], len(x)
    while at:
        p = back[at]
        raw = [number[f"<0x{b:02X}>"] for b in p.encode()] if f"<0x00>" in number else [number["<unk>"]]
        out = ([number[p]] if p in score else raw) + out
        at -= len(p)
    return out


def test_double_array_holds_its_words_and_no_others():
    r = random.Random(4)
    words = sorted({"".join(r.choice("abcdé日") for _ in range(r.randrange(1, 6))) for _ in range(400)})
    t = DoubleArray(words)

    def find(w):
        state = 0
        for c in w:
            code = t.code.get(c, 0)
            nxt = int(t.base[state]) + code
            if not code or t.check[nxt] != state:
                return -1
            state = nxt
        return int(t.value[state])
    assert [find(w) for w in words] == list(range(len(words)))
    for _ in range(2000):
        w = "".join(r.choice("abcdé日x") for _ in range(r.randrange(1, 7)))
        assert (find(w) >= 0) == (w in set(words))


@pytest.mark.parametrize("seed", range(6))
def test_paths_against_plain_viterbi(seed):
    r = random.Random(seed)
    model = toy(r, prefix=seed % 2 == 0, with_bytes=seed % 3 != 2)
    texts = ["", " ", "  ", "a", "abc ab", "日本日", "x", "\n\n", "😀a"] + [
        "".join(r.choice("aaabc  日é\n😀x") for _ in range(r.randrange(1, 40))) for _ in range(150)]
    u = Unigram(model)
    got = [a.tolist() for a in u.encode(texts)]
    assert got == [plain(model, t) for t in texts]
    if seed % 3 != 2:
        assert [u.decode(g) for g in got] == texts


def test_cache_may_be_dropped(monkeypatch):
    import tessera.llm.sentencepiece as m
    u = Unigram(toy())
    texts = [f"ab{'c' * k} a" for k in range(30)]
    want = [a.tolist() for a in u.encode(texts)]
    monkeypatch.setattr(m, "CACHE_WORDS", 5)
    small = Unigram(toy())
    assert [small.encode([t])[0].tolist() for t in texts] == want


def test_a_hash_of_two_words_is_noticed(monkeypatch):
    texts = ["ab a", "ca b", "abc", "aa"]
    want = [a.tolist() for a in Unigram(toy()).encode(texts)]
    u = Unigram(toy())
    whole = u._hashes
    monkeypatch.setattr(u, "_hashes", lambda *x: [h * 0 if k == 0 and u.seed < 2 else h for k, h in enumerate(whole(*x))])
    assert [a.tolist() for a in u.encode(texts)] == want and u.seed == 2


@pytest.mark.parametrize("letters", ["a", "abc", "ab日\nx"])
def test_long_words(monkeypatch, letters):
    import tessera.llm.sentencepiece as m
    r = random.Random(5)
    model, texts = toy(), ["".join(r.choice(letters) for _ in range(700)) for _ in range(4)]
    for long in (3, 50, 1000):
        monkeypatch.setattr(m, "LONG", long)
        assert [a.tolist() for a in Unigram(model).encode(texts)] == [plain(model, t) for t in texts]


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no model file")
def test_a_text_without_spaces_takes_no_longer_than_ten_times_one_with():
    import time
    r = random.Random(2)
    with open(MODEL, "rb") as f:
        model = PieceModel.read(f.read())
    text = "".join(r.choice("etaoinshrdlu") + (" " if r.random() < 0.2 else "") for _ in range(300_000))

    def seconds(t):
        u, at = Unigram(model), time.process_time()
        ids = u.encode([t])[0]
        spent = time.process_time() - at
        assert u.decode(ids) == t
        return spent
    spaced = seconds(text)
    assert seconds(text.replace(" ", "")) < 10 * spaced
    assert seconds("ab" * 150_000) < 10 * spaced


def test_broken_bytes_decode_to_replacement():
    u = Unigram(toy())
    ids = [u.bytes[b] for b in b"\xe6\x97" + "é".encode() + b"\xff"]
    assert u.decode(ids) == "��é�"


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no model file")
def test_model_file_reads_as_the_library_does():
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    with open(MODEL, "rb") as f:
        model = PieceModel.read(f.read())
    assert [p[0] for p in model.pieces] == [lib.id_to_piece(k) for k in range(lib.get_piece_size())]
    assert [p[1] for p in model.pieces] == [lib.get_score(k) for k in range(lib.get_piece_size())]
    u = Unigram(model)
    texts = ["Hello  wörld\n日本 ", "the quick brown fox", " x", "tab\there", "😀"]
    for t, ids in zip(texts, u.encode(texts), strict=True):
        assert u.decode(ids) == t == lib.decode(ids.tolist())


def test_awkward_rows_round_trip(spark):
    df, rows = awkward(spark, ["a b  c", "日本 x", "w" * 30_000, "line\nline\n", "▁ marker"])
    got = decode(encode(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == (r.text or "").replace(MARK, " ")
        assert (r.ids == []) == (not r.text)
    assert encode(empty(documents(spark, [(1, "a")]))).count() == 0
