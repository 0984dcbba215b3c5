"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols: insult, threat, target, negation, reported speech.
Five small transducers each follow one pattern through a clause; composed, they
step together, and their product says of every insult and threat whether it is
aimed, negated or reported.  A clause in quotes or behind a colon begins as
reported speech if a word of saying leads to it or follows it.  A threat is a verb
of violence with a target or an insult behind it, or a target before it.  Matched
clauses carry the weights; a document's score is a logistic function of what its clauses add up to.  Which words and
word beginnings are insults, and how much they weigh, is learned from labelled
documents beside a short fixed list.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, id_class, materialize
from tessera.llm.training import TRAIN_ROWS, labelled, logistic

#: Predicted 1 from this score on.
TOXIC = 0.7
#: Learned words and beginnings, at most.
LEXICON = 20_000
PREFIXES = (4, 5, 6, 7)

# Symbols of common words in four languages.
WORDS = {
    "insult": "idiot moron imbecile scum bastard loser retard trash filth vermin stupid worthless pathetic disgusting "
              "dumb arschloch dreckskerl abschaum trottel connard salaud ordure abruti cabron basura escoria",
    "target": "you your yours u he she him her they them their people those these du dich dir ihr euch sie er tu toi te "
              "vous il elle ils eux tú ti usted ustedes ellos ellas",
    "negation": "not no never isn't aren't don't without nicht kein keine nie ne pas jamais sans nunca tampoco sin",
    "report": "said says say saying told tells claimed claims wrote writes quoted called sagte schrieb behauptet "
              "dit disait écrit dijo dice escribió",
}

# Stems of verbs of violence with the endings of what is yet to be done, and of what is told.
THREATS = [
    ("kill hurt destroy beat shoot stab murder burn hang strangle", "", "s ed ing en"),
    ("stabb strangl", "-", "ed ing"),
    ("töt umbring vernicht", "en", "e est et t te ete st"),
    ("tu frapp étrangl", "er erai era", "e es ez ent é ait"),
    ("mat golpe estrangul", "ar aré ará aremos", "o as an aron aba"),
]
#: Weight of a told threat beside one yet to be done.
TOLD = 0.25
SAID = 3


def threat_forms() -> dict[str, float]:
    """Forms of the verbs of violence and their weights."""
    out: dict[str, float] = {}
    for stems, coming, told in THREATS:
        for stem in stems.split():
            out |= {stem + e: TOLD for e in told.split() if stem + e not in out}
            out |= {stem + e: 1.0 for e in coming.split(" ") if e != "-"}
    return out


class Transducer:
    """A deterministic weighted automaton over symbols: a state counts down a
    scope of ``reach`` words that ``opens`` opens (0 lasts to the clause's end)."""

    def __init__(self, opens: str, reach: int) -> None:
        self.opens, self.reach = opens, reach

    def step(self, state: int, symbol: str) -> tuple[int, bool]:
        """The next state, and whether the symbol stands in the scope."""
        inside = state != 0
        if symbol == self.opens:
            return (self.reach or -1), inside
        return (state - 1 if state > 0 else state), inside


class Composed:
    """The product of transducers, its transitions worked out on first use."""

    def __init__(self, *parts: Transducer) -> None:
        self.parts, self.table = parts, {}

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], tuple[bool, ...]]:
        key = (state, symbol)
        if key not in self.table:
            moves = [p.step(s, symbol) for p, s in zip(self.parts, state, strict=True)]
            self.table[key] = tuple(m[0] for m in moves), tuple(m[1] for m in moves)
        return self.table[key]

    def run(self, symbols: list[str], opened: str = "") -> list[tuple[bool, ...]]:
        """The scopes that every symbol stands in; the scope of ``opened`` is open from the start."""
        state, out = (0,) * len(self.parts), []
        if opened:
            state, _ = self.step(state, opened)
        for s in symbols:
            state, inside = self.step(state, s)
            out.append(inside)
        return out


#: Read forwards: aimed by a target before, negated, reported; read backwards: aimed by a target behind.
FORWARD = Composed(Transducer("target", 4), Transducer("negation", 3), Transducer("report", 0), Transducer("threat", 5))
BACKWARD = Composed(Transducer("target", 4))

QUOTES = "\"“”„«»"
_token = re.compile(rf"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n{QUOTES}]+")
#: Evidence of a document: constant, best insult, best clause, weights of plain, aimed, negated and reported
#: insults, threats, all weights per word.
PRIOR = np.array([-4.0, 1.0, 0.5, 0.5, 0.7, 0.1, 0.1, 3.0, 0.2])


@dataclass
class Grammar:
    """Insult weights of words and of beginnings, and the weights of evidence."""

    words: dict[str, float]
    beginnings: dict[str, float]
    weights: np.ndarray = field(default_factory=PRIOR.copy)

    def __post_init__(self) -> None:
        self.threats = threat_forms()
        self.symbols = dict.fromkeys(self.threats, "threat") | {w: s for s, ws in WORDS.items() for w in ws.split() if s != "insult"}
        self.insults = {w: 2.0 for w in WORDS["insult"].split()} | self.words
        self.sizes = sorted({len(p) for p in self.beginnings})
        self.memo: dict[str, float] = {}

    def insult(self, word: str) -> float:
        """Insult weight of a lower-case word: its own or its best beginning's."""
        got = self.memo.get(word)
        if got is None:
            got = max([self.insults.get(word, 0.0), *(self.beginnings.get(word[:n], 0.0) for n in self.sizes if len(word) >= n)])
            if len(self.memo) > 500_000:
                self.memo.clear()
            self.memo[word] = got
        return got

    def clauses(self, text: str) -> list[tuple[list[str], list[float], bool]]:
        """The clauses that have an insult or a threat: symbols, weights of
        insults and threats, and whether the clause is quoted from someone.

        A quote is what stands between quotation marks, a line's end closes it
        too; it is someone's if a word of saying stands in the clause before it
        or among the first ``SAID`` words behind it.  What follows a colon
        behind such a word is someone's to the sentence's end.
        """
        out: list[tuple[list[str], list[float], bool]] = []
        words: list[str] = []
        spoke = quoted = quote_said = colon_said = False
        start, closed = 0, None  # the first clause of the quote that is open; the clauses of the one just closed
        for token in [*_token.findall(text.lower()), "."]:
            if token[0].isalpha():
                words.append(token)
                continue
            if words:
                weights = [self.insult(w) for w in words]
                symbols = ["insult" if x else self.symbols.get(w, "") for w, x in zip(words, weights, strict=True)]
                if closed:
                    if "report" in symbols[:SAID]:
                        out[closed] = [(s, w, True) for s, w, _ in out[closed]]
                    closed = None
                if any(weights) or "threat" in symbols:
                    weights = [self.threats[w] if s == "threat" else x for w, s, x in zip(words, symbols, weights, strict=True)]
                    out.append((symbols, weights, quote_said or colon_said))
                if not quoted:
                    spoke = "report" in symbols
                words = []
            for mark in token:
                if mark in QUOTES and not quoted:
                    quoted, quote_said, start = True, spoke, len(out)
                elif mark in QUOTES or (quoted and mark == "\n"):
                    closed = slice(start, len(out))
                    quoted = quote_said = colon_said = spoke = False
                elif mark == ":" and not quoted:
                    colon_said = spoke
                elif mark != ":" and not quoted:
                    spoke = colon_said = False
        return out

    def evidence(self, text: str) -> list[float]:
        """What the matched clauses of the whole text add up to."""
        worst = best = plain = aimed = negated = reported = threats = told = 0.0
        for symbols, weights, quoted in self.clauses(text):
            ahead = FORWARD.run(symbols, "report" if quoted else "")
            behind = BACKWARD.run(symbols[::-1])[::-1]
            clause = armed = 0.0
            for s, w, (to, no, said, threat), (after,) in zip(symbols, weights, ahead, behind, strict=True):
                context = (0.6 if no else 1.0) * (0.7 if said else 1.0)
                if s == "insult":
                    part = w * (1.25 if to or after else 1.0) * context
                    clause += part
                    worst = max(worst, part)
                    if no:
                        negated += w
                    elif said:
                        reported += w
                    elif to or after:
                        aimed += w
                    else:
                        plain += w
                hit = 0.0
                if s == "threat":
                    armed = w
                    hit = 0.5 * w if to and not after else 0.0
                elif threat and s in ("target", "insult"):
                    hit, armed = armed, 0.0
                if hit:
                    part = hit * context * (0.4 if no or said else 1.0)
                    clause += 2 * part
                    worst = max(worst, 2 * part)
                    if hit < 0.5:
                        told = max(told, part)
                    else:
                        threats += part
            best = max(best, clause)
        per_word = 100 * (plain + aimed + negated + reported) / max(1, len(text) / 6)
        return [1.0, worst, *map(math.log1p, (best, plain, aimed, negated, reported, threats + told, per_word))]

    def score(self, texts) -> np.ndarray:
        x = np.array([self.evidence(t or "") for t in texts], dtype=float).reshape(-1, len(PRIOR))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


def lexicon(train: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings that toxic documents have too often for chance.

    Documents with a feature are counted in Spark, by label, copies and near
    copies once: of documents whose least hash of four words in a row is the
    same, one is counted.  A feature counts if its share of toxic documents is above the base rate by so much that
    among all features none would be by chance (a bound on the binomial tail
    times the number of features); its weight is its smoothed log odds.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(pdf["text"], pdf["y"], strict=True):
                words = {t for t in _token.findall(text.lower()) if t[0].isalpha()}
                own = {"=" + w for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) >= n}
                seen[1 if y else 0].update(own)
            keys = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"f": keys, "neg": [seen[0][k] for k in keys], "pos": [seen[1][k] for k in keys]})

    run = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 4, F.lit(0))), lambda k: F.xxhash64(F.slice("w", k + 1, 4)))
    sign = F.array_min(F.when(F.size("w") > 0, run))
    train = (train.withColumn("w", F.split(F.lower("text"), r"\s+")).withColumn("sign", sign)
             .groupBy("sign").agg(F.max_by("text", F.struct("y", "id")).alias("text"), F.max("y").alias("y")))
    train = materialize(train, "toxic_distinct")
    table = materialize(train.mapInPandas(count, "f string, neg long, pos long")
                        .groupBy("f").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")), "toxic_counts")
    docs = train.agg(F.count(F.lit(1)), F.sum("y")).first()
    total, toxic = docs[0], docs[1] or 0
    if not 0 < toxic < total:
        return {}, {}
    rate = toxic / total
    n = F.col("neg") + F.col("pos")
    share = F.col("pos") / n
    tail = n * (share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    weight = F.log((F.col("pos") + 0.5) / (F.col("neg") + 0.5)) - float(np.log(rate / (1 - rate)))
    many = table.count()
    rows = (table.where("pos > 0").where(share >= min(0.9, rate + 0.15)).where(tail > float(np.log(many) + 2))
            .select("f", weight.alias("w"), tail.alias("tail")).orderBy(F.desc("tail"), "f").limit(LEXICON).collect())
    words = {r["f"][1:]: min(r["w"], 6.0) for r in rows if r["f"].startswith("=")}
    return words, {r["f"]: min(r["w"], 6.0) for r in rows if not r["f"].startswith("=")}


def train_grammar(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
                  modulus: int = 3, held_out: int = 1, bound: int = TRAIN_ROWS) -> Grammar:
    """The grammar fitted on about ``bound`` labelled documents outside the
    held-out class; the driver gets a bounded lexicon and eight figures a row."""
    python_tasks(docs.sparkSession)
    train = materialize(labelled(docs, labels, label, modulus, held_out, id_col, text_col, bound)
                        .withColumn("y", (F.col("y") > 0).cast("int")), "toxic_train")
    made = Grammar(*lexicon(train))

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[float(v) for v in made.evidence(t)] for t in texts], dtype=object)

    got = train.select("id", "y", of("text").alias("x")).toPandas().sort_values(["id", "y"])
    x = np.array(got["x"].tolist(), dtype=float).reshape(-1, len(PRIOR))
    return Grammar(made.words, made.beginnings, logistic(x, got["y"].to_numpy(float), PRIOR, 0.5))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    modulus: int = 3, held_out: int = 1, bound: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``held_out``, ``score``,
    ``predicted``.

    Null texts count as empty; texts without a matched clause, empty ones too,
    get the score of no evidence.  Without labels of both kinds the fixed
    lexicon and weights decide.  Repeated rows are scored alike; an empty table
    gives an empty result; other columns of ``docs`` are not looked at.
    """
    grammar = train_grammar(docs, labels, id_col, text_col, "toxic", modulus, held_out, bound)
    grammar.memo = {}

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(grammar.score(texts))

    scored = docs.select(F.col(id_col), (id_class(id_col, modulus) == held_out).alias("held_out"), of(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= TOXIC, 1).otherwise(0))
