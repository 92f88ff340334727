"""Learned operators held against plain recounts: lexicons, trees, mixtures and language sets."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import langid, toxicity


def test_lexicon_by_plain_counts(spark):
    """Every term of every document, tested one by one; more terms pass than any cut would keep."""
    rng = np.random.default_rng(0)
    bad, plain = [f"bad{i}" for i in range(60)], [f"word{i}" for i in range(80)]
    rows = []
    for i in range(160):
        toxic = i % 4 == 0
        words = [*rng.choice(plain, 20), *(rng.choice(bad, 25) if toxic else rng.choice(bad, int(rng.random() < 0.1)))]
        rows.append((int(rng.integers(0, 2)), toxic, " ".join(words)))
    sizes = {(f, t): sum(r[0] == f and r[1] is t for r in rows) for f in (0, 1) for t in (False, True)}
    p = toxicity.ToxicityParams()
    got = toxicity.learn_lexicons(spark.createDataFrame(rows, "fold int, toxic boolean, text string"), sizes, p)
    for lexicon, folds in zip(got, ((0, 1), (1,), (0,)), strict=True):
        own = [(t, set(np.concatenate(toxicity.terms(x)).tolist())) for f, t, x in rows if f in folds]
        share = sum(t for t, _ in own) / len(own)
        want = set()
        for term in set().union(*(w for _, w in own)) - {0}:
            a, b = (sum(term in w for t, w in own if t is kind) for kind in (True, False))
            rate = a / (a + b)
            if a < p.least_docs or rate < 0.8 or rate <= share:
                continue
            ratio = 2 * (a * math.log(rate / share) + (b * math.log((1 - rate) / (1 - share)) if b else 0))
            if ratio >= p.least_ratio:
                want.add(term)
        assert set(lexicon.tolist()) == want
    assert len(got[0]) > 20


def test_features_by_plain_counts():
    f = toxicity.Features(np.unique(toxicity.word_hashes("grumble")))
    x = dict(zip(toxicity.FEATURES, f.of("You IDIOT, you grumble! 1d1ot z z z z z z z z moron 22").tolist(), strict=True))
    words = 15
    assert x["log_words"] == pytest.approx(math.log(1 + words), rel=1e-6)
    assert x["fixed_density"] == pytest.approx(100 * 2 / words, rel=1e-6) and x["learned_density"] == pytest.approx(100 * 1 / words, rel=1e-6)
    assert x["second_density"] == pytest.approx(100 * 2 / words, rel=1e-6)
    # idiot and grumble stand within five words of a second-person word, moron does not
    assert x["near_second"] == pytest.approx(2 / 3, rel=1e-6)
    assert x["undone_density"] == pytest.approx(100 / words, rel=1e-6) and x["exclamations"] == pytest.approx(100 / words, rel=1e-6)
    assert f.of("").tolist() == [0.0] * len(toxicity.FEATURES)


def test_first_split_is_the_best_of_all():
    """A single stump against every feature and cut."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (200, len(toxicity.FEATURES))).astype(np.float32)
    y = ((x[:, 4] > 2) & (rng.random(200) < 0.9)).astype(np.int64)
    p = toxicity.ToxicityParams(trees=1, depth=1, least_gain=0.0)
    model = toxicity.fit_trees(x, y, x, y, p)
    prob = y.mean()
    g, h = prob - y, prob * (1 - prob)
    gain = lambda m: (g[m].sum() ** 2) / (h * m.sum() + 1)
    best = max(((gain(x[:, j] <= c) + gain(x[:, j] > c), j, c) for j in range(x.shape[1]) for c in range(6)), key=lambda t: t[0])
    (feature, cut, value), edges = model.nodes[0], model.edges
    assert feature[0] == best[1] == 4 and edges[4][cut[0]] == best[2]
    left = x[:, 4] <= best[2]
    assert value[0] == pytest.approx(-p.rate * g[left].sum() / (h * left.sum() + 1)) and value[1] == pytest.approx(-p.rate * g[~left].sum() / (h * (~left).sum() + 1))
    # ties between rows of equal features get one score
    assert len(set(model.score(x[[0, 0, 0]]))) == 1


def test_proportions_reach_the_largest_likelihood():
    """Expectation-maximisation against a grid over all proportions."""
    rng = np.random.default_rng(2)
    for _ in range(10):
        ll = rng.normal(size=(30, 2)) * 3
        value, w = langid._em(ll, 400)
        grid = np.linspace(0, 1, 2001)[:, None]
        with np.errstate(divide="ignore"):
            total = np.logaddexp(np.log(grid) + ll[:, 0], np.log(1 - grid) + ll[:, 1]).sum(1)
        assert value == pytest.approx(total.max(), abs=0.02) and w.sum() == pytest.approx(1)
        assert w[0] == pytest.approx(float(grid[total.argmax(), 0]), abs=0.03)


def test_language_set_by_all_subsets():
    """The set found by growing equals the best of all subsets under the same penalty, where languages are apart."""
    p = langid.LangParams()
    rng = np.random.default_rng(3)
    alphabets = ["abcdefg", "hijklmn", "opqrstu"]
    say = lambda i, n: " ".join("".join(rng.choice(list(alphabets[i]), 5)) for _ in range(n))
    table = np.full((1 << p.bits, 3), p.smoothing)
    for i in range(3):
        table[:, i] += np.bincount(langid.grams(say(i, 3000), p)[0], minlength=1 << p.bits)
    model = langid.Model(["a", "b", "c"], np.log(table / table.sum(0)).astype(np.float32))
    for shares in ((40, 0, 0), (0, 30, 12), (10, 20, 50), (0, 0, 3), (16, 24, 0)):
        text = " ".join(say(i, n) for i, n in enumerate(shares) if n)
        ll = model.units(text, p)
        best = None
        for k in (1, 2, 3):
            for own in itertools.combinations(range(3), k):
                value, w = langid._em(ll[:, own], p.rounds) if k > 1 else (float(ll[:, own[0]].sum()), np.ones(1))
                value -= p.penalty * (k - 1)
                if best is None or value > best[0]:
                    best = (value, own, w)
        lang, score = model.infer(text, p)
        assert lang == model.languages[best[1][int(best[2].argmax())]] and score == pytest.approx(float(best[2].max()), abs=0.02)
        assert lang == "abc"[int(np.argmax(shares))]
    assert model.infer("12 34 !", p) == (langid.UNDETERMINED, 0.0)


def test_ties_between_languages_go_to_the_first(spark):
    rows = [(i, "aaa bbb ccc ddd", g) for i, g in enumerate(["xx", "yy"] * 40)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))).collect()
    assert {r["lang_pred"] for r in got} <= {"xx", "yy"} and len({r["lang_pred"] for r in got}) == 1
