"""Quality classifier: a sparse ensemble of rules over statistics of texts.

Random trees are grown on a bounded sample of labelled rows. Every path from a root to a node is a
rule, a conjunction of comparisons. A logistic model with a lasso penalty picks and weighs rules, and
the result is one Spark column expression over the statistics.

Defined cases: a null text is empty; an empty text has all statistics 0 and the score of those;
repeated rows get equal scores; an empty table gives no rows; with labels of one kind only, or of
none, every score is the share of label 1, or 0.5; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.llm.sample import SAMPLE_ROWS, held_out, labelled_sample
from recordtrust.llm.text import Texts, byte_values, chunks, span_hash, windows, words_of
from recordtrust.sources.workspace import Workspace

FOLD, REST, THRESHOLD = 5, 0, 0.3
SIGNS = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digits": b"0123456789",
    "symbols": b"#*$%&|<>",
    "shouts": b"!?",
    "stops": b".",
    "commas": b",;:",
    "high": bytes(range(128, 256)),
}
STATISTICS = (
    "words", "word_bytes", "lines", "words_per_line", "words_per_stop", "distinct_words", "same_neighbours", "repeated_windows", "repeated_lines",
    "longest_word", *[f"{s}_share" for s in SIGNS],
)


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _repeated(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many keys of each row also occur earlier in it."""
    order = np.lexsort((keys, rows))
    again = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    return np.bincount(rows[order][1:][again], minlength=n)


def statistics(texts: Texts) -> np.ndarray:
    """STATISTICS of every text, one column each."""
    data, at = texts
    n, size = len(texts), np.diff(at)
    words = words_of(texts)
    rows, count = words.rows(), np.diff(words.first)
    letters = words.end - words.start
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    line = np.flatnonzero(edge[:-1] | np.r_[False, data[:-1] == 10][: len(data)]) if len(data) else np.zeros(0, np.int64)
    line_end = np.append(line[1:], len(data)) if len(data) else line
    line_row = np.searchsorted(at, line, "right") - 1
    # The line feed that ends a line is no part of it.
    line_keys = span_hash(byte_values(False)[data], line, line_end - (data[line_end - 1] == 10)) if len(data) else line.astype(np.uint64)
    lines = np.bincount(line_row, minlength=n)
    starts, keys = windows(words, 5)
    near = np.zeros(len(rows), bool)
    near[1:] = (words.hash[1:] == words.hash[:-1]) & (rows[1:] == rows[:-1])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, letters)
    some = np.maximum(count, 1)
    shares = []
    for signs in SIGNS.values():
        table = np.zeros(256, bool)
        table[list(signs)] = True
        shares.append(_per_row(table[data], at))
    stops = shares[list(SIGNS).index("stops")]
    return np.column_stack(
        [
            count, np.bincount(rows, letters, n) / some, lines, count / np.maximum(lines, 1), count / (stops + 1),
            1 - _repeated(words.hash, rows, n) / some, np.bincount(rows[near], minlength=n) / some, _repeated(keys, rows[starts], n) / some,
            _repeated(line_keys, line_row, n) / np.maximum(lines, 1), longest, *[s / np.maximum(size, 1) for s in shares],
        ]
    ).astype(np.float64)


def with_statistics(documents: DataFrame, *kept: str) -> DataFrame:
    """The ``kept`` columns and STATISTICS of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            found = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), *(pa.array(found[:, i]) for i in range(len(STATISTICS)))], names=[*kept, *STATISTICS]
            )

    source = documents.select(*kept, "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name in kept]
    return source.mapInArrow(run, ", ".join([*kinds, *[f"{s} double" for s in STATISTICS]]))


class Test(NamedTuple):
    """One comparison of a statistic."""

    feature: int
    above: bool
    value: float

    def column(self) -> Column:
        c = F.col(STATISTICS[self.feature])
        return c > self.value if self.above else c <= self.value


Rule = tuple[Test, ...]


def simplify(path: Sequence[Test]) -> Rule:
    """The same conjunction with one test per statistic and direction."""
    tightest: dict[tuple[int, bool], float] = {}
    for t in path:
        old = tightest.get((t.feature, t.above))
        tightest[t.feature, t.above] = t.value if old is None else max(old, t.value) if t.above else min(old, t.value)
    return tuple(Test(f, above, v) for (f, above), v in sorted(tightest.items()))


def paths(tree: str) -> list[Rule]:
    """Rules of a tree's nodes, from Spark's printed form: one test per line, indented by depth."""
    found, path = [], []
    for text in tree.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", text):
            path = path[: len(m[1])]
            path += [None] * (len(m[1]) - len(path)) + [Test(int(m[2]), m[3] == ">", float(m[4]))]
            found.append(simplify([t for t in path if t is not None]))
    return found


def compiled(rule: Rule) -> Column:
    return reduce(Column.__and__, (t.column() for t in rule))


class Ensemble(NamedTuple):
    constant: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        odds = F.lit(self.constant)
        for rule, weight in self.rules:
            odds = odds + F.when(compiled(rule), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(sample: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 0.0005) -> Ensemble:
    """Rules and weights from rows with STATISTICS and ``label``."""
    rows = sample.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col("label").cast("double"), *STATISTICS)
    total, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not total or ones in (0, total):
        share = ones / total if total else 0.5
        return Ensemble(float(np.log((share + 1e-6) / (1 - share + 1e-6))), ())
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, subsamplingRate=0.7, featureSubsetStrategy="0.5", minInstancesPerNode=5).fit(rows)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree.toDebugString)})
    if not rules:
        return Ensemble(float(np.log(ones / (total - ones))), ())
    flags = rows.select(array_to_vector(F.array(*[compiled(r).cast("double") for r in rules])).alias("features"), "label").cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(flags)
    flags.unpersist()
    picked = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w)
    return Ensemble(float(lasso.intercept), picked)


def classify(documents: DataFrame, labels: DataFrame, workspace: Workspace, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    sample = labelled_sample(documents, labels, "quality", FOLD, REST, sample_rows)
    known = workspace.stage(with_statistics(sample, "label"), "sample").repartition(8)
    score = fit(known).score()
    return (
        with_statistics(documents, "doc_id")
        .withColumn("score", score)
        .select("doc_id", held_out(FOLD, REST).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )
