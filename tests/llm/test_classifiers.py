import random
import zlib

import numpy as np
import pytest

from tessera.llm.quality import FEATURES, PAIRS, features, fit, quality_scores, train
from tessera.llm.toxicity import BACKWARD, FORWARD, Grammar, toxicity_scores
from tests.llm.tables import awkward, documents, empty

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def measured(rows, labels):
    """Accuracy and AUC on held-out labels."""
    pairs = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y, _ in pairs if y], [s for s, y, _ in pairs if not y]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    return np.mean([p == y for _, y, p in pairs]), auc


@pytest.mark.parametrize("scores, label, modulus, held", [(quality_scores, "quality", 4, 2), (toxicity_scores, "toxic", 3, 1)])
def test_held_out_accuracy(spark, scores, label, modulus, held):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = scores(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in got)
    # some junk texts keep the toxic label of what they were made from; nothing toxic is left in them
    truth = {r["doc_id"]: r[label] for r in labels.collect() if label == "quality" or r["quality"]}
    accuracy, auc = measured(got, truth)
    assert accuracy > 0.97 and auc > 0.98
    # all held-out labels, those of junk texts too
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    found = [r["predicted"] for r in got if r["held_out"] and truth.get(r["doc_id"]) == 1]
    print(label, "held out, all labels: accuracy and AUC", measured(got, truth), "recall", np.mean(found), len(found))
    assert measured(got, truth)[0] > 0.95 and np.mean(found) > 0.75


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_awkward_rows_and_labels(spark, scores):
    df, rows = awkward(spark, ["you are an idiot", "a fine day in May. It was good.", "", "!!! ### $$$", "w " * 3000])
    labels = spark.createDataFrame([(0, 0, 1), (0, 0, 1), (1, 1, 0), (None, 1, 0), (3, None, None), (77, 1, 0)], LABELS)
    for given in (labels, empty(labels)):
        got = scores(df, given).collect()
        assert len(got) == len(rows) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
        assert scores(empty(df), given).count() == 0
    null = [r for r in got if r.doc_id is None]
    assert len(null) == 1 and not null[0].held_out


def test_held_out_labels_do_not_matter(spark):
    rows = [(k, ("good text here. " if k % 2 else "BAD!! STUFF## ") * (3 + k % 5)) for k in range(80)]
    def scored(flip):
        labels = [(k, int((k % 2 == 1) != (flip and zlib.crc32(str(k).encode()) % 4 == 2)), 0) for k, _ in rows]
        return sorted((r.doc_id, r.score) for r in quality_scores(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect())
    assert scored(False) == scored(True)


def test_bradley_terry_orders_pairs():
    r = np.random.default_rng(1)
    x = r.random((300, len(FEATURES)))
    strength = 3 * x[:, 0] - 2 * x[:, 3]
    y = (strength > np.median(strength)).astype(int)
    m = fit(x, y)
    assert np.corrcoef(m.rank(x), strength)[0, 1] > 0.95
    assert abs((m.rank(x) >= m.threshold).mean() - y.mean()) < 0.02  # the quantile of the bad share


def test_weights_are_those_of_all_pairs():
    r = np.random.default_rng(3)
    x, y = r.normal(size=(400, len(FEATURES))), (r.random(400) < 0.4).astype(int)
    x[y == 1, 0] += 1.5
    m = fit(x, y)
    z = np.clip((x - m.mean) / m.scale, -8, 8)
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, len(FEATURES))
    each = min(PAIRS, 50 * max((y == 1).sum(), (y == 0).sum())) / len(d)
    slope = m.weights - each * (d / (1 + np.exp(d @ m.weights))[:, None]).sum(0)
    assert np.abs(slope).max() < 1e-3 * each * len(d)


def test_every_labelled_row_is_fitted_on(spark):
    # more rows than a fit once took
    rows = [(k, ("good text here. " if k % 2 else "BAD!! STUFF## ") * (1 + k % 7)) for k in range(28_000)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k, _ in rows], LABELS)
    m = train(documents(spark, rows), labels)
    kept = [(t, k % 2) for k, t in rows if zlib.crc32(str(k).encode()) % 4 != 2]
    assert len(kept) > 20_000
    of = {t: features(t) for t in {t for t, _ in kept}}
    x, y = np.array([of[t] for t, _ in kept]), np.array([y for _, y in kept])
    assert np.allclose(m.mean, x.mean(0), atol=1e-8) and np.allclose(m.scale, np.where(x.std(0) > 1e-9, x.std(0), 1), atol=1e-8)
    whole = fit(x, y)
    assert np.allclose(m.weights, whole.weights, atol=1e-4) and abs(m.threshold - whole.threshold) < 1e-3


def test_features_of_odd_texts():
    for text in ("", " \n ", "a", " ", "| | |", "x" * 100_000, "a\n" * 10):
        f = features(text)
        assert len(f) == len(FEATURES) and np.isfinite(f).all()


def plain_marks(symbols):
    """Aimed, negated, reported of every word, straight from the definition."""
    out = []
    for k in range(len(symbols)):
        before = lambda s, reach: any(symbols[j] == s for j in range(max(0, k - reach) if reach else 0, k))  # noqa: B023, E731
        out.append((before("target", 4), before("negation", 3), before("report", 0), before("threat", 5)))
    return out


def test_composed_transducers_against_definition():
    r = random.Random(2)
    for _ in range(300):
        s = [r.choice(["", "", "", "target", "negation", "report", "threat", "insult"]) for _ in range(r.randrange(12))]
        assert FORWARD.run(s) == plain_marks(s)
        after = [any(x == "target" for x in s[k + 1:k + 5]) for k in range(len(s))]
        assert [m[0] for m in BACKWARD.run(s[::-1])[::-1]] == after


def test_clauses_weigh_by_context():
    g = Grammar({}, {"scu": 2.0})
    score = lambda t: g.score([t])[0]
    aimed, plain = score("you are an idiot and scum"), score("what an idiot, scum")
    negated, reported = score("he is not an idiot"), score("she said that idiot came")
    assert aimed > negated and plain > score("a fine day")
    assert negated < score("he is an idiot") and reported < score("that idiot came")
    assert score("i will kill you") > score("i will kill time")
    assert g.insult("scumbag") == 2.0 and g.insult("sc") == 0


def test_quoted_speech_is_reported():
    g = Grammar({}, {})
    score = lambda t: g.score([t])[0]
    direct, said = score("you idiot"), score("he said you idiot")
    for quoted in ('he said: "you idiot"', 'she wrote, "you idiot"', '"you idiot", he said', "„du Trottel“, sagte er", "he said: you idiot"):
        assert abs(score(quoted) - said) < 0.05 < direct - score(quoted), quoted
    # neither a quote without a word of saying nor what stands behind a quote, a sentence or a line is anyone's
    for own in ('he came. "you idiot"', 'he said "come". you idiot', "he said: come. you idiot", 'he said "come\nyou idiot', '"you idiot". he came and said'):
        assert score(own) > 0.6, own


def test_threats():
    g = Grammar({}, {})
    score = lambda t: g.score([t])[0]
    will = score("i will kill you")
    assert will > 0.5 and will > score("i will meet you") + 0.4 and score("we are going to strangle them") > 0.5
    assert score("i will not kill you") < 0.2 and score('he said: "i will kill you"') < 0.2
    assert score("i will meet you") < score("i killed you") < score("they should hang") < will
    assert score("kill that idiot") > score("what an idiot")
    assert score("they killed people. " * 50) < 0.3  # told, however often
    assert score("i will kill time") == score("a fine day")
