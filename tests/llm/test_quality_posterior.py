"""The quality posterior: expectation-maximisation text by text in plain Python, and Bayes' rule on given weights."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from recordtrust.llm import quality_rules as q

NAMES = ["one", "two", "three"]


def beliefs():
    return {n: q.Rule(F.lit(None), F.lit(None), hits, 0.005) for n, hits in zip(NAMES, (0.3, 0.2, 0.1), strict=True)}


def chance(vote, rate):
    """How likely a vote is if the rule calls texts of a kind bad at that rate; abstaining tells nothing."""
    return {q.BAD: rate, q.GOOD: 1 - rate, q.ABSTAIN: 1.0}[vote]


def plain(texts, prior=0.85, trust=0.2, trust_good=1.0, limit=0.01, rounds=100):
    """Rates of each rule on good and bad texts, the share of good texts, and every text's posterior."""
    n = len(texts)
    good_rate, bad_rate, share = [0.005] * 3, [0.3, 0.2, 0.1], prior
    for _ in range(rounds):
        posterior = []
        for votes in texts:
            good = share * math.prod(chance(v, r) for v, r in zip(votes, good_rate, strict=True))
            bad = (1 - share) * math.prod(chance(v, r) for v, r in zip(votes, bad_rate, strict=True))
            posterior.append(good / (good + bad))
        new_good, new_bad = [], []
        for k, (hits, false) in enumerate(zip((0.3, 0.2, 0.1), [0.005] * 3, strict=True)):
            for rates, weights, belief, faith in (
                (new_good, posterior, false, trust_good * n * prior),
                (new_bad, [1 - p for p in posterior], hits, trust * n * (1 - prior)),
            ):
                cast = [w for w, v in zip(weights, texts, strict=True) if v[k] != q.ABSTAIN]
                called = [w for w, v in zip(weights, texts, strict=True) if v[k] == q.BAD]
                rates.append((sum(called) + faith * belief) / (sum(cast) + faith))
        good_rate, bad_rate = [min(r, limit) for r in new_good], [max(r, 2 * limit) for r in new_bad]
        share = (sum(posterior) + trust * n * prior) / (n * (1 + trust))
    return good_rate, bad_rate, share


@pytest.mark.parametrize("seed", range(4))
def test_estimate_text_by_text(spark, seed):
    rng = random.Random(seed)
    kinds = [[rng.choice([q.GOOD, q.GOOD, q.ABSTAIN, q.BAD]) for _ in NAMES] for _ in range(6)]
    texts = [tuple(rng.choice(kinds)) if rng.random() < 0.3 else (q.GOOD, rng.choice([q.GOOD, q.ABSTAIN]), q.GOOD) for _ in range(150)]
    good, bad, share = plain(texts)
    patterns = sorted((k, len(list(g))) for k, g in itertools.groupby(sorted(texts)))
    found = q.estimate(patterns, beliefs())
    assert found.constant == pytest.approx(math.log(share / (1 - share)), abs=1e-9)
    for k, name in enumerate(NAMES):
        assert found.terms[name] == pytest.approx((math.log(good[k] / bad[k]), math.log((1 - good[k]) / (1 - bad[k]))), abs=1e-9)


def test_posterior_is_bayes_rule(spark):
    """The column expression gives each combination of votes the posterior of independent rules."""
    good, bad, share = (0.004, 0.01, 0.002), (0.4, 0.1, 0.3), 0.7
    terms = {n: (math.log(g / b), math.log((1 - g) / (1 - b))) for n, g, b in zip(NAMES, good, bad, strict=True)}
    rows = list(itertools.product((q.BAD, q.ABSTAIN, q.GOOD), repeat=3))
    odds = q.Weights(math.log(share / (1 - share)), terms).log_odds()
    found = spark.createDataFrame(rows, ", ".join(f"{n} byte" for n in NAMES)).select(*NAMES, (1 / (1 + F.exp(-odds))).alias("p")).collect()
    for r in found:
        a = share * math.prod(chance(r[n], x) for n, x in zip(NAMES, good, strict=True))
        b = (1 - share) * math.prod(chance(r[n], x) for n, x in zip(NAMES, bad, strict=True))
        assert r.p == pytest.approx(a / (a + b), abs=1e-12)


def test_no_texts(spark):
    found = q.estimate([], beliefs())
    assert found.constant == pytest.approx(math.log(0.85 / 0.15))
