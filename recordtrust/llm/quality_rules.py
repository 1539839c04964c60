"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at a few statistics of a text and votes good or bad, or abstains. How often a rule
votes either way on good and on bad texts is unknown; expectation-maximisation estimates it from the
counts of all vote patterns, starting from what the rules' authors believe. A text's posterior
probability of being good then follows from its votes, and replaces "all rules must pass".

Only DataFrame functions touch the rows. The driver sees one count per vote pattern, at most 3 to
the number of rules.

Defined cases: a null text has no words; an empty text fails the base rules; texts with equal votes
get equal posteriors; repeated rows repeat; an empty table gives no rows (and the prior beliefs as
weights); further columns are ignored by the statistics and kept by ``filter_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.sources.workspace import Workspace

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_lower", "n_ends")
GOOD, BAD, ABSTAIN = 1, -1, 0


def with_base(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of BASE and EXTRA, counted over the whole text."""
    source = F.coalesce(F.col(text), F.lit(""))
    own = [c for c in documents.columns]
    hashed = F.transform("__words", lambda w: F.xxhash64(w))
    window = F.when(
        F.size("__hashes") >= WINDOW,
        F.transform(
            F.slice("__hashes", F.lit(1), F.size("__hashes") - (WINDOW - 1)),
            lambda h, i: F.xxhash64(h, *[F.get("__hashes", i + k) for k in range(1, WINDOW)]),
        ),
    )
    ordered = F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter(
        "__ordered",
        lambda x, i: ((i > 0) & (F.get("__ordered", i - 1).h == x.h)) | F.coalesce(F.get("__ordered", i + 1).h == x.h, F.lit(False)),
    )
    places = F.array_sort(F.transform(twice, lambda x: x.i))
    steps = F.transform("__places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW))))
    return (
        documents.withColumn("__words", F.array_remove(F.split(source, r"[\x20\x09-\x0D]+"), ""))
        .withColumn("__hashes", hashed)
        .withColumn("__windows", window)
        # Only texts with a repeated window pay for sorting their windows.
        .withColumn("__ordered", F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), ordered))
        .withColumn("__places", places)
        .withColumn("__lines", F.filter(F.split(source, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .select(
            *own,
            F.size("__words").cast("long").alias("n_words"),
            F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
            F.regexp_count(source, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size("__lines").cast("long").alias("n_lines"),
            F.regexp_count(source, F.lit("[A-Z]")).cast("long").alias("n_upper"),
            F.regexp_count(source, F.lit("[a-z]")).cast("long").alias("n_lower"),
            F.regexp_count(source, F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")).cast("long").alias("n_ends"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


class Rule(NamedTuple):
    """Bad where ``bad`` holds, good where ``good`` holds, no vote elsewhere; and what its author believes:
    the share of bad texts it calls bad and the share of good texts it calls bad."""

    bad: Column
    good: Column
    hits: float
    false: float


def rules() -> dict[str, Rule]:
    c, per_word = F.col, F.greatest(F.col("n_words"), F.lit(1))
    length, letters = c("word_chars") / per_word, F.greatest(c("n_upper") + c("n_lower"), F.lit(1))
    lines = F.greatest(c("n_lines"), F.lit(1))
    return {
        "symbols": Rule(c("n_symbols") > 0.3 * per_word, c("n_symbols") <= 0.15 * per_word, 0.3, 0.005),
        "repeats": Rule(c("n_repeat_words") > 0.2 * per_word, c("n_repeat_words") <= 0.15 * per_word, 0.3, 0.005),
        "lines": Rule((c("n_dup_lines") >= 2) & (c("n_dup_lines") > 0.3 * lines), c("n_dup_lines") <= 1, 0.2, 0.005),
        "capitals": Rule((c("n_upper") > 0.5 * letters) & (letters >= 20), (c("n_upper") <= 0.3 * letters) & (letters >= 20), 0.3, 0.005),
        "density": Rule(c("n_symbols") > 0.06 * c("word_chars"), c("n_symbols") <= 0.03 * c("word_chars"), 0.3, 0.005),
        "sentences": Rule((c("n_words") >= 40) & (c("n_words") > 40 * c("n_ends")), (c("n_words") >= 40) & (c("n_words") <= 30 * c("n_ends")), 0.3, 0.005),
        "length": Rule((length < 2) | (length > 15), (length >= 3) & (length <= 10), 0.1, 0.005),
    }


def vote(rule: Rule) -> Column:
    return F.when(rule.bad, BAD).when(rule.good, GOOD).otherwise(ABSTAIN).cast("byte")


class Weights(NamedTuple):
    """Log odds of good: a constant, and one term for every rule's bad and good vote."""

    constant: float
    terms: Mapping[str, tuple[float, float]]

    def log_odds(self) -> Column:
        score = F.lit(self.constant)
        for name, (bad, good) in self.terms.items():
            score = score + F.when(F.col(name) == BAD, bad).when(F.col(name) == GOOD, good).otherwise(0.0)
        return score


def estimate(patterns: list[tuple[tuple[int, ...], int]], beliefs: Mapping[str, Rule], prior: float = 0.85, trust: float = 0.2, trust_good: float = 1.0, max_false: float = 0.01, rounds: int = 100) -> Weights:
    """Expectation-maximisation over vote patterns and their counts.

    Beliefs about bad texts count as ``trust`` times, those about good texts as ``trust_good`` times
    as many texts as there are, so the result is the same for any number of copies of a corpus.
    No rule is taken to call more than ``max_false`` of the good texts bad.
    Rules for different kinds of junk hardly ever agree; without a firm belief that each seldom
    calls a good text bad, junk that one rule alone sees would be taken for a habit of good texts.
    """
    names, total = list(beliefs), sum(n for _, n in patterns)
    believed = {BAD: {n: r.hits for n, r in beliefs.items()}, GOOD: {n: r.false for n, r in beliefs.items()}}
    weight = {BAD: trust * total * (1 - prior), GOOD: trust_good * total * prior}
    says, share = believed, prior  # class -> rule -> how often a vote, if any, is bad

    def term(name: str, ballot: int) -> float:
        good, bad = says[GOOD][name], says[BAD][name]
        return math.log(good / bad) if ballot == BAD else math.log((1 - good) / (1 - bad)) if ballot == GOOD else 0.0

    for _ in range(rounds if total else 0):
        goods = []
        for votes, _n in patterns:
            odds = math.log(share / (1 - share)) + sum(map(term, names, votes))
            goods.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))))
        found: dict[int, dict[str, float]] = {GOOD: {}, BAD: {}}
        for at, name in enumerate(names):
            for y in found:
                cast = [(v[at], n * (p if y == GOOD else 1 - p)) for (v, n), p in zip(patterns, goods, strict=True)]
                tripped = sum(m for ballot, m in cast if ballot == BAD) + weight[y] * believed[y][name]
                rate = tripped / (sum(m for ballot, m in cast if ballot != ABSTAIN) + weight[y])
                found[y][name] = min(rate, max_false) if y == GOOD else max(rate, 2 * max_false)
        says = found
        share = (sum(n * p for (_v, n), p in zip(patterns, goods, strict=True)) + trust * total * prior) / (total * (1 + trust))
    return Weights(math.log(share / (1 - share)), {n: (term(n, BAD), term(n, GOOD)) for n in names})


def fit_weights(voted: DataFrame, beliefs: Mapping[str, Rule]) -> Weights:
    counts = voted.groupBy(*beliefs).count().collect()  # one row per vote pattern
    return estimate(sorted((tuple(r[n] for n in beliefs), r["count"]) for r in counts), beliefs)


def judge(documents: DataFrame, workspace: Workspace, threshold: float = 0.5) -> DataFrame:
    """BASE statistics, base_failed, the posterior ``quality`` and ``kept`` of every document."""
    voters = rules()
    stats = with_base(documents.select("doc_id", "text")).drop("text")
    voted = workspace.stage(stats.select("doc_id", *BASE, *[vote(r).alias(n) for n, r in voters.items()]), "votes")
    odds = fit_weights(voted, voters).log_odds()
    quality = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return voted.select("doc_id", *BASE, base_failed().alias("base_failed"), quality.alias("quality")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )


def filter_documents(documents: DataFrame, workspace: Workspace, threshold: float = 0.5) -> DataFrame:
    """Documents that pass the base rules and whose posterior quality is at least ``threshold``.

    The text is read once for the votes, which are written next to the rows they belong to.
    """
    voters = rules()
    marks = [vote(r).alias(f"__vote_{n}") for n, r in voters.items()]
    renamed = {n: Rule(F.lit(None), F.lit(None), r.hits, r.false) for n, r in ((f"__vote_{n}", r) for n, r in voters.items())}
    source = documents.select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    stats = with_base(source, "__text").select("__row", base_failed().alias("__failed"), *marks)
    voted = workspace.stage(stats, "votes")
    odds = fit_weights(voted, renamed).log_odds()
    good = ~F.col("__failed") & (F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)) >= threshold)
    return voted.where(good).select("__row.*")
