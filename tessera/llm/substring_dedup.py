"""Substring de-duplication by level-wise doubling of repeated windows.

A window is a run of words, known by a name: the name of 2k words mixes the
names of its halves, so names of any length come from those of single words by
doubling.  Levels: half windows (25 words) that begin in two documents are
extended to whole ones (50), and of those only the ones that begin in a
document with a smaller id go on; a document without a half that is repeated
is done after the first level, and its text is read no more.

Half windows are not all sent to the first level, but the least of each
stretch that a whole window spans, by its name: equal windows have the same
least half in the same place, so no repeated window is lost, and about one
half in 13 is sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.common import materialize, python_tasks
from tessera.llm.sieve import passes, sieve_of

WINDOW = 50
#: Bytes of text that a task handles as one array.
BATCH = 8_000_000
# Odd multipliers of the mixing (any would do).
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One name for two, order included."""
    with np.errstate(over="ignore"):
        x = a * _A + (b ^ (b >> np.uint64(31))) * _B
        x = (x ^ (x >> np.uint64(29))) * _C
        return x ^ (x >> np.uint64(32))


def _joined(names: np.ndarray, size: int, more: np.ndarray, by: int) -> np.ndarray:
    """Names of ``size + by`` words from those of ``size`` and, behind them, of
    ``by``; the last ones, that reach over the end, are nobody's."""
    out = np.zeros_like(names)
    out[:max(0, len(names) - size)] = _mix(names[:max(0, len(names) - size)], more[size:])
    return out


def names_of(words: np.ndarray, size: int) -> np.ndarray:
    """The name of the ``size`` words from each word on, by doubling."""
    part, span = words, 1  # names of a power of two words
    whole, have = None, 0
    while True:
        if size & span:
            whole = part if whole is None else _joined(whole, have, part, span)
            have += span
        if have == size:
            return whole
        part, span = _joined(part, span, part, span), span * 2


def least(names: np.ndarray, span: int) -> np.ndarray:
    """Index of the least name (the first of equal ones) among the ``span``
    from each place on, by doubling; stretches end with the array."""
    at, have = np.arange(len(names)), 1
    while have < span:
        by = min(have, span - have)
        right = at[np.minimum(np.arange(len(at)) + by, len(at) - 1)]
        at = np.where(names[right] < names[at], right, at)
        have += by
    return at


class Batch:
    """The words of some texts (UTF-8) in one array of names."""

    def __init__(self, texts: list[bytes | None], window: int) -> None:
        self.words = [t.split() if t else [] for t in texts]  # bytes split at ASCII white space only
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        flat = [w for words in self.words for w in words]
        codes, kinds = pd.factorize(np.array(flat + [None], object)[:-1])
        one = np.fromiter(map(xxh64_intdigest, kinds), np.uint64, len(kinds))[codes] if len(flat) else np.zeros(0, np.uint64)
        half = (window + 1) // 2  # the halves of odd windows share a word
        self.halves = names_of(one, half) if len(one) else one
        self.shift = window - half
        self.row = np.repeat(np.arange(len(texts)), self.counts)
        place = np.arange(len(one)) - self.first[self.row]
        self.starts = np.flatnonzero(place + window <= self.counts[self.row])  # where a window begins
        self.anchor = least(self.halves, self.shift + 1)[self.starts]  # and the half that stands for it

    def window_names(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for each of ``starts[which]``."""
        a, b = self.halves[self.starts[which]], self.halves[self.starts[which] + self.shift]
        return _mix(a, b).view(np.int64), (_mix(b, ~a) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _batches(frames: Iterator[pd.DataFrame], window: int) -> Iterator[tuple[pd.DataFrame, Batch]]:
    for frame in frames:
        size = frame["text"].str.len().fillna(0).cumsum().to_numpy()
        cut = (size // BATCH).astype(int)
        for k in np.unique(cut):
            rows = frame[cut == k].reset_index(drop=True)
            yield rows, Batch(rows["text"].tolist(), window)


def _digest(words: list[bytes]) -> bytes:
    return sha256(b" ".join(words)).digest()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_removed`` and
    ``kept_sha256`` (SHA-256 of the words that stay, joined by spaces), and
    ``removed``, the removed runs of words as ``start, end`` in order.

    Words are what stands between ASCII white space.  A word goes if it is in
    a window of ``window`` words whose sequence also begins in a row with a
    smaller id; what goes is judged on the texts as they are.  A null id is
    smaller than any other; rows of one id take nothing from each other.  Null,
    empty and short texts lose nothing.  An empty table gives an empty result;
    other columns are not looked at.

    Sent between tasks are names, ids and places, texts only of documents with
    a repeated half window (and of the sieve's few false ones).  Counts of a
    name are pre-aggregated before their exchange, and the join of a name with
    its places is one that adaptive execution can split.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    python_tasks(docs.sparkSession)
    # a row is known by its id and a hash of its text: rows alike in both have the same result
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63)).alias("id"),
                       F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("text"))

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, b in _batches(frames, window):
            anchors = np.unique(b.anchor)
            cuts = np.searchsorted(b.row[anchors], np.arange(len(rows) + 1))
            spot, name = (anchors - b.first[b.row[anchors]]).astype(np.int32), b.halves[anchors].view(np.int64)
            out = rows[["id", "key"]].copy()
            out["n_words"], out["whole"] = b.counts, list(map(_digest, b.words))
            out["names"] = [name[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
            out["spots"] = [spot[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
            yield out

    halves = materialize(base.select("id", "key", "text").mapInPandas(
        first, "id long, key long, n_words long, whole binary, names array<long>, spots array<int>"), "substring_halves")

    # level 1: halves that begin in two documents, and where
    repeated = (halves.select("id", F.explode("names").alias("name")).groupBy("name")
                .agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("name"))
    spots = (halves.select("id", "key", F.explode(F.arrays_zip("names", "spots")).alias("s"))
             .select("id", "key", F.col("s.names").alias("name"), F.col("s.spots").alias("spot")).join(repeated, "name", "left_semi"))
    hits = materialize(spots.groupBy("id", "key").agg(F.collect_set("spot").alias("spots")), "substring_hits")

    # level 2: whole windows over those halves, in the documents that have one
    passed = passes(base.select("id", "key", "text"), F.col("key"), sieve_of(hits.select("key"), "key", "substring_sieve"))
    live = materialize(passed.join(hits, ["id", "key"]), "substring_live")

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, b in _batches(frames, window):
            where = np.concatenate([b.first[k] + np.asarray(s, np.int64) for k, s in enumerate(rows["spots"])])
            which = np.flatnonzero(np.isin(b.anchor, where))
            start = b.starts[which]
            row = b.row[start]
            name, check = b.window_names(which)
            yield pd.DataFrame({"id": rows["id"].to_numpy()[row], "key": rows["key"].to_numpy()[row], "name": name, "check": check,
                                "start": (start - b.first[row]).astype(np.int32)})

    found = live.select("id", "key", "spots", "text").mapInPandas(windows, "id long, key long, name long, check int, start int")
    earliest = found.groupBy("name", "check").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("name", "check", "low")
    later = found.join(earliest, ["name", "check"]).where("low < id")
    gone = materialize(later.groupBy("id", "key").agg(F.collect_set("start").alias("starts")), "substring_gone")

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"id": [], "key": [], "n_removed": [], "left": [], "removed": []}
            for row in frame.itertuples(index=False):
                words, starts = row.text.split(), np.sort(np.asarray(row.starts, np.int64))
                open_ = np.flatnonzero(np.diff(starts, prepend=-2 * window) > window)  # a new run, not touching the one before
                runs = list(zip(starts[open_].tolist(), (starts[np.append(open_[1:], len(starts)) - 1] + window).tolist(), strict=True))
                left, at = [], 0
                for a, b in runs:
                    left += words[at:a]
                    at = b
                left += words[at:]
                for c, v in zip(out, (row.id, row.key, len(words) - len(left), _digest(left), [{"start": a, "end": b} for a, b in runs]), strict=True):
                    out[c].append(v)
            yield pd.DataFrame(out)

    # rows alike in id and text have one result
    rest = live.select("id", "key", "text").join(gone, ["id", "key"]).mapInPandas(
        kept, "id long, key long, n_removed long, left binary, removed array<struct<start:int,end:int>>").dropDuplicates(["id", "key"])
    return _result(halves, rest, docs, id_col)


def _result(halves: DataFrame, rest: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    given = F.when(F.col("id") != -2 ** 63, F.col("id")).cast(docs.schema[id_col].dataType)
    return halves.select("id", "key", "n_words", "whole").join(rest, ["id", "key"], "left").select(
        given.alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.lower(F.hex(F.coalesce("left", "whole"))).alias("kept_sha256"),
        F.coalesce("removed", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("removed"))
