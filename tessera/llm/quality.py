"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is a weighted sum of its features; the weights make a
document labelled good beat one labelled bad, by logistic loss on the
difference of their features, over every pair of a good and a bad one.  A
document is accepted if its score is above the quantile of the labelled scores
that the share of bad labels gives.

All labelled rows take part and none comes to the driver: their features are
written once, and each round of the fit is a pass over them.  The pairs are not
listed.  A pair's loss depends on its two scores only, so rows are summed by
class and cell of their score, and cells are compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_class, materialize, python_tasks
from tessera.llm.sieve import passes, sieve_of
from tessera.llm.training import chosen_labels

#: What all pairs together weigh beside the pull of the weights to 0.
PAIRS = 60_000
#: Cells of scores to one unit of score, and the cells at both ends, which take all that lies beyond.
CELLS, END = 32, 1024
#: Predicted 1 from this score on.
ACCEPT = 0.7

_upper = re.compile("[A-Z]")
_symbol = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_stop = re.compile(r"[.!?…]")
_bang = re.compile(r"[!?]{2,}")
FEATURES = ("log_words", "upper", "digit", "symbol", "bang", "stop", "word_len", "long_words", "unique",
            "repeat", "top_word", "top_line", "lines", "packed", "symbol_words", "shout_words", "bar_words",
            "worst_window", "one_letter")


def features(text: str) -> list[float]:
    """Figures of the whole text, each about 0 to 3."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    same = [a == b for a, b in zip(words, words[1:], strict=False)]
    lines = [s for line in text.split("\n") if (s := line.strip())]
    line_counts = Counter(lines)
    # the windows of 50 words in which words repeat most
    worst = max((1 - len(set(words[k:k + 50])) / len(words[k:k + 50]) for k in range(0, max(1, n - 25), 50)), default=0.0)
    raw = text.encode()
    packed = len(zlib.compress(raw, 1)) / len(raw)
    symbols = len(_symbol.findall(text))
    shout = sum(w.isupper() and len(w) > 2 for w in words)
    return [
        np.log1p(n) / 4, sum(map(str.isupper, text)) / chars * 4, sum(map(str.isdigit, text)) / chars * 4,
        min(3.0, symbols / n), min(3.0, len(_bang.findall(text)) / n * 3), min(3.0, len(_stop.findall(text)) / n * 4),
        min(3.0, (chars - n) / n / 6), sum(len(w) > 18 for w in words) / n, len(counts) / n,
        sum(same) / n * 3, counts.most_common(1)[0][1] / n * 2, line_counts.most_common(1)[0][1] / max(1, len(lines)),
        min(3.0, len(lines) / n * 10), packed * 2,
        sum(not w[-1].isalnum() and w[-1] not in ".,;:!?'\")" for w in words) / n * 2, shout / n * 2,
        min(3.0, words.count("|") / n * 4), worst * 2, sum(len(w) == 1 for w in words) / n * 2]


def _rows(texts) -> np.ndarray:
    return np.array([features(t or "") for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _dot(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A row's score, to the bit the same in whatever batch the row comes."""
    return (z * w).sum(1)


@dataclass
class QualityModel:
    """``mean`` and ``scale`` of the features, their ``weights``, and the
    ``threshold`` and ``spread`` of the scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return _dot(_standard(x, self.mean, self.scale), self.weights)

    def score(self, texts) -> np.ndarray:
        """0 to 1, ``ACCEPT`` at the threshold."""
        z = (self.rank(_rows(texts)) - self.threshold) / self.spread + np.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _cell(s: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(s * CELLS), -END, END).astype(np.int64)


def _celled(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> pd.DataFrame:
    """Rows, scores and features of the good and the bad, summed by cell."""
    s = _dot(z, w)
    frame = pd.DataFrame(np.column_stack([np.ones(len(s)), s, z]), columns=_SUMS)
    return frame.assign(y=y, cell=_cell(s))[(y == 0) | (y == 1)].groupby(["y", "cell"], as_index=False).sum()


def _weighed(z: np.ndarray, y: np.ndarray, w: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, weighed by class and cell."""
    on = (y == 0) | (y == 1)
    z, y = z[on], y[on]
    return (z * weight[y, _cell(_dot(z, w)) + END][:, None]).T @ z


_SUMS = ["n", "s", *(f"z{k}" for k in range(len(FEATURES)))]


class Held:
    """Labelled rows in memory: features ``x`` and labels ``y``."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.x, self.y = x, np.asarray(y).astype(np.int64)

    def moments(self) -> tuple[int, np.ndarray, np.ndarray]:
        return len(self.x), self.x.mean(0), self.x.std(0)

    def standardise(self, mean: np.ndarray, scale: np.ndarray) -> None:
        self.z = _standard(self.x, mean, scale)

    def cells(self, w: np.ndarray) -> pd.DataFrame:
        return _celled(self.z, self.y, w)

    def weighed(self, w: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return _weighed(self.z, self.y, w, weight)

    def spread(self, w: np.ndarray) -> float:
        return float(np.std(_dot(self.z, w)))

    def at(self, w: np.ndarray, ranks: list[int]) -> list[float]:
        return np.sort(_dot(self.z, w))[ranks].tolist()


class Stored:
    """Labelled rows in a written table ``x, y``; each method is a pass over
    it.  What reaches the driver is bounded by the cells and the tasks."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows

    def moments(self) -> tuple[int, np.ndarray, np.ndarray]:
        each = range(len(FEATURES))
        got = self.rows.agg(F.count(F.lit(1)), *[F.avg(F.col("x")[k]) for k in each], *[F.stddev_pop(F.col("x")[k]) for k in each]).first()
        return got[0], np.array(got[1:1 + len(FEATURES)], float), np.array(got[1 + len(FEATURES):], float)

    def standardise(self, mean: np.ndarray, scale: np.ndarray) -> None:
        self.mean, self.scale = mean, scale

    def _each(self, of, schema: str) -> DataFrame:
        """``of`` (z, y) of every batch."""
        mean, scale = self.mean, self.scale

        def run(batches):
            for rows in batches:
                if len(rows):
                    yield of(_standard(np.array(rows["x"].tolist(), dtype=float), mean, scale), rows["y"].to_numpy())

        return self.rows.mapInPandas(run, schema)

    def cells(self, w: np.ndarray) -> pd.DataFrame:
        rows = self._each(lambda z, y: _celled(z, y, w), "y long, cell long, " + ", ".join(f"{c} double" for c in _SUMS))
        sums = rows.groupBy("y", "cell").agg(*[F.sum(c).alias(c) for c in _SUMS])
        return pd.DataFrame([r.asDict() for r in sums.collect()], columns=["y", "cell", *_SUMS]).sort_values(["y", "cell"])

    def weighed(self, w: np.ndarray, weight: np.ndarray) -> np.ndarray:
        part = self._each(lambda z, y: pd.DataFrame({"row": range(z.shape[1]), **dict(zip(_SUMS[2:], _weighed(z, y, w, weight).T, strict=True))}),
                          "row int, " + ", ".join(f"{c} double" for c in _SUMS[2:]))
        got = part.groupBy("row").agg(*[F.sum(c) for c in _SUMS[2:]]).orderBy("row").collect()
        return np.array([list(r)[1:] for r in got], float)

    def _scores(self, w: np.ndarray) -> DataFrame:
        return self._each(lambda z, y: pd.DataFrame({"s": _dot(z, w)}), "s double")

    def spread(self, w: np.ndarray) -> float:
        return self._scores(w).agg(F.stddev_pop("s")).first()[0]

    def at(self, w: np.ndarray, ranks: list[int]) -> list[float]:
        placed = materialize(self._scores(w), "quality_ranks").orderBy("s").rdd.map(lambda r: r[0]).zipWithIndex()
        found = {place: s for s, place in placed.filter(lambda r: r[1] in ranks).collect()}
        return [found[k] for k in ranks]


class _Pairs:
    """Loss, slope and curvature of all pairs at the weights ``w``."""

    def __init__(self, rows: Held | Stored, w: np.ndarray) -> None:
        self.rows, self.w, cells = rows, w, rows.cells(w)
        (self.kb, n, self.xb, b), (self.kg, m, self.xg, g) = (
            (part["cell"].to_numpy(), part["n"].to_numpy(), part[_SUMS[2:]].to_numpy(), (part["s"] / part["n"]).to_numpy())
            for part in (cells[cells["y"] == 0], cells[cells["y"] == 1]))
        total = m.sum() * n.sum()
        self.each = min(PAIRS, 50 * max(m.sum(), n.sum())) / total
        apart = g[:, None] - b[None, :]
        self.loss = float(self.each * (m @ np.logaddexp(0, -apart) @ n) + 0.5 * w @ w)
        lost = 1 / (1 + np.exp(np.clip(apart, -700, 700)))
        self.slope = self.each * (m @ lost @ self.xb - (lost @ n) @ self.xg) + w
        self.flat = lost * (1 - lost)
        self.n, self.m = n, m

    def curvature(self) -> np.ndarray:
        weight = np.zeros((2, 2 * END + 1))
        weight[0, self.kb + END], weight[1, self.kg + END] = self.m @ self.flat, self.flat @ self.n
        across = self.xg.T @ self.flat @ self.xb
        return self.each * (self.rows.weighed(self.w, weight) - across - across.T) + np.eye(len(self.w))


def _weights(rows: Held | Stored, rounds: int = 60) -> np.ndarray:
    """Newton's method over all pairs, drawn to 0."""
    now = _Pairs(rows, np.zeros(len(FEATURES)))
    for _ in range(rounds):
        step = np.linalg.solve(now.curvature(), now.slope)
        scale = 1.0
        while (after := _Pairs(rows, now.w - scale * step)).loss > now.loss * (1 + 1e-5) and scale > 1e-4:
            scale /= 2
        if scale <= 1e-4:
            break
        won, now = now.loss - after.loss, after
        if won < 1e-5 * max(1.0, now.loss):  # less than cells tell apart
            break
    return now.w


def _fit(rows: Held | Stored, n: int, bad: int, good: int) -> QualityModel:
    mean, scale, weights = np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES))
    if not (good and bad):  # nothing to tell apart: all are accepted
        return QualityModel(mean, scale, weights, -1.0, 1e-6 if n else 1.0)
    # rounded, so that the order in which tasks are summed does not show
    _, mean, scale = (np.round(v, 9) for v in rows.moments())
    scale = np.where(scale > 1e-9, scale, 1.0)
    rows.standardise(mean, scale)
    weights = np.round(_weights(rows), 6)
    k = min(bad, n - 1)
    threshold = float(np.mean(rows.at(weights, [k - 1, k])))  # between the last of the share and the first above
    return QualityModel(mean, scale, weights, threshold, max(round(rows.spread(weights), 9) / 4, 1e-6))


def fit(x: np.ndarray, y: np.ndarray) -> QualityModel:
    """The model of rows in memory: weights by all pairs of good and bad."""
    return _fit(Held(x, y), len(y), int((y == 0).sum()), int((y == 1).sum()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
          modulus: int = 4, held_out: int = 2) -> QualityModel:
    """Fit on the features of every labelled document outside the held-out
    class.  Null labels and ids are no labels; of several labels of one id the
    largest holds; repeated documents count each.

    Labels may be many, so texts are not joined with them: a sieve of the
    labelled ids holds back the other texts in the scan, and only features meet
    the labels.
    """
    python_tasks(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_rows(texts)), dtype=object)

    chosen = materialize(chosen_labels(labels, label, modulus, held_out, id_col), "quality_labels")
    sieve = sieve_of(chosen.select(F.col("lid").cast("string").alias("key")), "key", "quality_sieve")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    x = materialize(passes(texts, F.col("id").cast("string"), sieve).select("id", of("text").alias("x")), "quality_features")
    rows = materialize(x.join(chosen, F.col("id") == F.col("lid")).select("x", F.col("y").cast("long").alias("y")), "quality_rows")
    n, bad, good = rows.agg(F.count(F.lit(1)), F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    return _fit(Stored(rows), n, bad, good)


def score_column(text: Column, model: QualityModel) -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return of(text)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   modulus: int = 4, held_out: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``held_out``, ``score``,
    ``predicted``.

    Null texts count as empty; an empty text has all features 0 and is scored
    as that.  Without labels of both kinds every document is accepted.
    Repeated rows are scored alike; an empty table gives an empty result;
    other columns of ``docs`` are not looked at.
    """
    model = train(docs, labels, id_col, text_col, "quality", modulus, held_out)
    scored = docs.select(F.col(id_col), (id_class(id_col, modulus) == held_out).alias("held_out"),
                         score_column(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= ACCEPT, 1).otherwise(0))
