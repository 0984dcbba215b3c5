"""SentencePiece encoding and decoding: Unigram Viterbi over a double array.

Pieces with their log scores are kept in a double-array trie.  A text is
marked (spaces become U+2581) and cut into words before every marker that
follows something else; no piece reaches over such a cut, so the best path
through the text is the best paths of its words joined.  Words that are not
known yet are encoded together: all starts walk the trie in step, words are cut
further where no piece crosses, and all parts advance through the Viterbi
recursion in step.  Characters that no piece covers become their UTF-8 bytes.
Texts are handled a batch at a time, as arrays of characters and words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks
from tessera.llm.piece_model import BYTE, NORMAL, UNKNOWN, USER_DEFINED, PieceModel

MARK = "▁"
#: What a character without a piece costs below the lowest score (a fixed value of the method).
UNKNOWN_PENALTY = 10.0
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words remembered by one Python worker (about 40 bytes each).
CACHE_WORDS = 1_500_000
#: Characters whose paths are sought at once; parts of words beyond LONG are walked by themselves.
STEP, LONG = 300_000, 1000
#: Code points there are.
POINTS = 0x110000


class DoubleArray:
    """Trie of strings in two arrays: the child of state s by code c is
    ``base[s] + c`` if ``check`` there is s."""

    def __init__(self, words: list[str]) -> None:
        chars = sorted({c for w in words for c in w})
        self.code = {c: k + 1 for k, c in enumerate(chars)}
        tree: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for number, word in enumerate(words):
            node = 0
            for c in word:
                node = tree[node].setdefault(self.code[c], len(tree))
                if node == len(tree):
                    tree.append({})
            ends[node] = number
        size = 2 * len(tree) + 4 * len(chars) + 4096
        used = np.zeros(size, bool)
        used[0] = True  # the root
        start = np.zeros(len(tree), np.int64)
        hint: dict[int, int] = {}
        # nodes with many children first, single children into the gaps
        for node in sorted((k for k in range(len(tree)) if tree[k]), key=lambda k: -len(tree[k])):
            codes = np.fromiter(tree[node], np.int64)
            at = hint.get(len(codes), 0)
            while True:
                tries = np.arange(at, at + 256)
                if tries[-1] + codes.max() >= len(used):
                    used = np.concatenate([used, np.zeros(len(used), bool)])
                free = ~used[tries[:, None] + codes[None, :]].any(axis=1)
                if free.any():
                    break
                at += 256
            start[node] = at = int(tries[free.argmax()])
            hint[len(codes)] = at
            used[at + codes] = True
        size = int(start.max()) + 2 * len(chars) + 2
        self.base, self.check, self.value = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1)
        place, todo = {0: 0}, [0]
        while todo:
            node = todo.pop()
            here = place.pop(node)
            self.base[here] = start[node]
            self.value[here] = ends.get(node, -1)
            for code, child in tree[node].items():
                place[child] = slot = int(start[node]) + code
                self.check[slot] = here
                todo.append(child)


class Unigram:
    """Encoder and decoder of one model."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        texts = [(t, i) for i, (t, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED) and t]
        if any(MARK in t.lstrip(MARK) for t, _ in texts):
            raise ValueError("a piece has a marker behind other characters")
        self.trie = DoubleArray([t for t, _ in texts])
        self.ids = np.array([i for _, i in texts], np.int64)
        low = min((model.pieces[i][1] for _, i in texts), default=0.0)
        top = max((model.pieces[i][1] for _, i in texts), default=0.0)
        self.scores = np.array([model.pieces[i][1] if model.pieces[i][2] == NORMAL else len(t) * top - 0.1 for t, i in texts])
        self.missing = low - UNKNOWN_PENALTY
        self.unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
        self.bytes = {int(t[3:-1], 16): i for i, (t, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.longest = max((len(t) for t, _ in texts), default=0)
        # what a character is: no piece's, a piece's, a marker; and its code in the trie
        self.kind = np.zeros(POINTS, np.uint8)
        self.code = np.zeros(POINTS, np.int64)
        for c, code in self.trie.code.items():
            self.kind[ord(c)], self.code[ord(c)] = 1, code
        self.kind[ord(MARK)] = 2
        spell = [t.replace(MARK, " ").encode() if kind in (NORMAL, USER_DEFINED) else bytes([int(t[3:-1], 16)]) if kind == BYTE
                 else " \u2047 ".encode() if kind == UNKNOWN else b"" for t, _, kind in model.pieces]
        self.spelt = np.frombuffer(b"".join(spell), np.uint8)
        self.spelt_size = np.array([len(x) for x in spell], np.int64)
        self.spelt_at = np.cumsum(self.spelt_size) - self.spelt_size
        self._salt(0)

    def mark(self, text: str) -> str:
        """The text with markers for spaces, as the model's flags say."""
        if self.model.squeeze_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if self.model.dummy_prefix else "") + text).replace(" ", MARK)

    # --- best paths ----------------------------------------------------------------
    def _arcs(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """``start, piece, reach, score`` of all pieces in the words: all starts
        walk the trie in step.  Characters without a piece of their own get an
        arc without one (-1), at the penalty."""
        n, first = len(points), np.cumsum(sizes) - sizes
        codes = self.code[points]
        room = np.repeat(first + sizes, sizes) - np.arange(n)  # characters left in the word
        state, live, found = np.zeros(n, np.int64), np.arange(n), []
        for k in range(min(self.longest, int(sizes.max(initial=0)))):
            live = live[room[live] > k]
            c, here = codes[live + k], state[live]
            nxt = self.trie.base[here] + c
            ok = (c > 0) & (self.trie.check[nxt] == here)
            live, nxt = live[ok], nxt[ok]
            state[live] = nxt
            piece = self.trie.value[nxt]
            has = piece >= 0
            found.append((live[has], piece[has], np.full(int(has.sum()), k + 1, np.int64)))
        start, piece, reach = (np.concatenate([f[x] for f in found]) if found else np.zeros(0, np.int64) for x in range(3))
        lone = np.ones(n, bool)
        lone[start[reach == 1]] = False
        lone = np.flatnonzero(lone)
        start, piece = np.concatenate([start, lone]), np.concatenate([piece, np.full(len(lone), -1)])
        reach = np.concatenate([reach, np.ones(len(lone), np.int64)])
        score = np.where(piece >= 0, self.scores[piece], self.missing) if len(self.scores) else np.full(len(piece), self.missing)
        return start, piece, reach, score

    def _paths(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best paths of the words, joined, and how many each has.
        Of equal ways to reach a place the one with the longest last piece wins."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        start, piece, reach, score = self._arcs(points, sizes)
        # words are cut further where no piece crosses: the best path goes through there
        over = np.cumsum(np.bincount(start + 1, minlength=n + 2)[:n] - np.bincount(start + reach, minlength=n + 2)[:n])
        first = np.flatnonzero(over == 0)
        part = np.diff(first, append=n)
        part_of = np.repeat(np.arange(len(first)), part)
        long = part > LONG
        ends, which = [], []
        if long.any():
            far = long[part_of[start]]
            for k in np.flatnonzero(long).tolist():
                lo, hi = int(first[k]), int(first[k] + part[k])
                own = far & (start >= lo) & (start < hi)
                e, w = _walk(hi - lo, start[own] - lo, piece[own], reach[own], score[own])
                ends.append(e + lo)
                which.append(w)
            start, piece, reach, score = (x[~far] for x in (start, piece, reach, score))
        # the others advance in step: a part of m characters has m + 1 slots, an arc goes from slot to slot
        depth = start - first[part_of[start]]
        key = depth * (self.longest + 1) + reach
        order = np.argsort(key.astype(np.uint16) if (LONG + 1) * (self.longest + 1) < 65536 else key, kind="stable")
        source, piece, reach, score, key = (start + part_of[start])[order], piece[order], reach[order], score[order], key[order]
        best = np.full(n + len(first), -np.inf)
        back, step = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int64)
        begin = first + np.arange(len(first))
        best[begin] = 0.0
        bounds = np.flatnonzero(np.diff(key, prepend=-1, append=-1))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            total, to = best[source[lo:hi]] + score[lo:hi], source[lo:hi] + reach[lo:hi]
            wins = total > best[to]
            to = to[wins]
            best[to], back[to], step[to] = total[wins], reach[lo:hi][wins], piece[lo:hi][wins]
        # and walk back in step
        left = np.flatnonzero(~long)
        at = begin + part
        while len(left):
            ends.append(at[left] - left)
            which.append(step[at[left]])
            at[left] -= back[at[left]]
            left = left[at[left] > begin[left]]
        ends, which = np.concatenate(ends), np.concatenate(which)
        order = np.argsort(ends)
        ends, which = ends[order], which[order]
        ids = np.where(which >= 0, self.ids[which], self.unknown) if len(self.ids) else np.full(len(which), self.unknown)
        word = np.repeat(np.arange(len(sizes)), sizes)[ends - 1]
        if self.bytes and (which < 0).any():
            lone = np.flatnonzero(which < 0)
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[ends[lone] - 1].tolist()]
            many = np.ones(len(ids), np.int64)
            many[lone] = [len(r) for r in raw]
            missing = np.repeat(which < 0, many)
            ids, word = np.repeat(ids, many), np.repeat(word, many)
            ids[missing] = [self.bytes[b] for r in raw for b in r]
        return ids.astype(np.int32), np.bincount(word, minlength=len(sizes))

    # --- words that were met before -----------------------------------------------------
    def _forget(self) -> None:
        """A cache of words: two hashes of a word, and where its ids are."""
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.flat, self.begin, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, points: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> None:
        """Remember the paths of new words (``keys`` ascend)."""
        order = np.argsort(sizes, kind="stable")  # words of like length together
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes[order]) // STEP, prepend=-1))
        at, count, flat, total = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), [self.flat], len(self.flat)
        for some in np.split(order, cuts[1:]):
            n = sizes[some]
            where = np.arange(int(n.sum())) + np.repeat(begin[some] - np.cumsum(n) + n, n)
            ids, counts = self._paths(points[where], n)
            at[some], count[some] = total + np.cumsum(counts) - counts, counts
            flat.append(ids)
            total += len(ids)
        self.flat = np.concatenate(flat)
        merged = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys, self.checks, self.begin, self.count = (
            np.concatenate(x)[merged] for x in ((self.keys, keys), (self.checks, checks), (self.begin, at), (self.count, count)))

    def _salt(self, seed: int) -> None:
        """The random values that words are hashed with."""
        rng = np.random.default_rng(seed)
        self.seed = seed
        self.salts = [(rng.integers(0, 2 ** 64, POINTS, np.uint64), np.uint64(2 * int(rng.integers(0, 2 ** 62)) + 1)) for _ in range(2)]
        self._forget()

    def _hashes(self, points: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Two hashes of every word."""
        place, out = np.arange(len(points)) - np.repeat(begin, sizes), []
        for of, base in self.salts:
            power = np.full(int(sizes.max()), base)
            power[0] = 1
            out.append(np.add.reduceat(of[points] * np.cumprod(power)[place], begin))
        return out

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and how many each has.  Everything is done
        for all characters or words of the texts at once."""
        if self.model.squeeze_spaces:
            texts = [re.sub(" +", " ", t).strip(" ") for t in texts]
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(points == 32, np.uint32(ord(MARK)), points)
        if self.model.dummy_prefix:
            points = np.insert(points, (np.cumsum(counts) - counts)[counts > 0], np.uint32(ord(MARK)))
            counts = counts + (counts > 0)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        # a word begins at a character that is no piece's, behind one, and at a marker behind another character
        kind = self.kind[points]
        before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
        starts = (kind == 0) | (before == 0) | ((kind == 2) & (before == 1))
        ends = np.cumsum(counts)
        starts[(ends - counts)[counts > 0]] = True
        begin = np.flatnonzero(starts)
        sizes = np.diff(begin, append=len(points))
        while True:
            keys, checks = self._hashes(points, begin, sizes)
            words, at, which = np.unique(keys, return_index=True, return_inverse=True)
            place = np.searchsorted(self.keys, words)
            known = np.append(self.keys, np.uint64(0))[place] == words
            known &= place < len(self.keys)
            if (checks == checks[at][which]).all() and (self.checks[place[known]] == checks[at][known]).all():
                break
            self._salt(self.seed + 1)  # two words of one hash: begin anew with others
        if len(self.keys) + int((~known).sum()) > CACHE_WORDS:
            self._forget()
            known[:] = False
        new = at[~known]
        if len(new):
            self._learn(words[~known], checks[new], points, begin[new], sizes[new])
        k = np.searchsorted(self.keys, words)[which]
        n = self.count[k]
        upto = np.cumsum(n)
        flat = self.flat[np.arange(int(upto[-1])) + np.repeat(self.begin[k] - upto + n, n)]
        # ids up to the end of each text
        last = np.searchsorted(begin, ends)
        return flat, np.diff(np.concatenate([[0], upto])[last], prepend=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        flat, counts = self.encode_flat(texts)
        return np.split(flat, np.cumsum(counts)[:-1]) if len(texts) else []

    # --- decoding ---------------------------------------------------------------------
    def decode_flat(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of joined ids, their pieces' bytes gathered at once."""
        ids = ids.astype(np.int64)
        n = self.spelt_size[ids]
        upto = np.cumsum(n)
        raw = self.spelt[np.arange(int(upto[-1]) if len(n) else 0) + np.repeat(self.spelt_at[ids] - upto + n, n)].tobytes()
        cuts = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if self.model.dummy_prefix and raw[a:a + 1] == b" ":
                a += 1
            try:
                out.append(raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(_utf8(raw[a:b]))
        return out

    def decode(self, ids) -> str:
        """The text of the ids: markers become spaces, the space that encoding
        put in front goes, bytes that are no UTF-8 become U+FFFD each.  It is
        the text that was encoded, but for markers in it, which are spaces now."""
        ids = np.asarray(ids, np.int64)
        return self.decode_flat(ids, np.array([len(ids)]))[0]


def _walk(n: int, start: np.ndarray, piece: np.ndarray, reach: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best path through one long part, arc by arc: where its pieces end, and which they are."""
    order = np.lexsort((reach, start))
    best, back, step = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for i, p, r, s in zip(start[order].tolist(), piece[order].tolist(), reach[order].tolist(), score[order].tolist(), strict=True):
        if best[i] + s > best[i + r]:
            best[i + r], back[i + r], step[i + r] = best[i] + s, r, p
    ends, which, at = [], [], n
    while at:
        ends.append(at)
        which.append(step[at])
        at -= back[at]
    return np.array(ends, np.int64), np.array(which, np.int64)


def _utf8(raw: bytes) -> str:
    """The text of bytes; each that belongs to no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as bad:
            out.append(raw[at:at + bad.start].decode() + "\ufffd")
            at += bad.start + 1
    return "".join(out)


_made: dict[int, Unigram] = {}


def _unigram(data) -> Unigram:
    """The encoder, built once per Python worker."""
    raw = data.value
    key = hash(raw)
    if key not in _made:
        _made.clear()
        _made[key] = Unigram(PieceModel.read(raw))
    return _made[key]


def load_model(spark: SparkSession, path: str = MODEL):
    """The model file (bounded: a vocabulary) as a broadcast, read by Spark
    or, for a plain path, by the driver."""
    if "://" in path:
        raw = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            raw = f.read()
    return spark.sparkContext.broadcast(raw)


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with ``out_col``, the array of piece ids of each text.

    Null texts are encoded as empty ones: no ids.  ``out_col`` replaces a
    column of that name; all others pass through.  No shuffle; a batch's
    texts and a bounded word cache are all that a task holds.
    """
    python_tasks(docs.sparkSession)
    data = load_model(docs.sparkSession, model)

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        ids, counts = _unigram(data).encode_flat([t or "" for t in texts.to_pylist()])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))

    return docs.withColumn(out_col, of(F.col(text_col)))


def decode(docs: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``docs`` with ``out_col``, the text of each array of ids (null: empty)."""
    python_tasks(docs.sparkSession)
    data = load_model(docs.sparkSession, model)

    @F.arrow_udf("string")
    def of(ids: pa.Array) -> pa.Array:
        counts = np.diff(ids.offsets.to_numpy()) if not ids.null_count else pc.fill_null(pc.list_value_length(ids), 0).to_numpy().astype(np.int64)
        return pa.array(_unigram(data).decode_flat(ids.flatten().to_numpy(zero_copy_only=False), counts), pa.string())

    return docs.withColumn(out_col, of(F.col(ids_col)))
