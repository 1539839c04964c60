"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A sentence's score is a logistic function of its features; a document's score is the noisy-or of its
sentences, 1 - prod(1 - p). Only documents are labelled, so the gradient of the document's likelihood
tells which sentences to blame. Features are words in lower case and their beginnings of 3 to 8
bytes. Sentences end at ``.``, ``!``, ``?`` or a line feed.

The model is fitted on a bounded sample of labelled rows (``sample_rows``) over at most ``n_features``
features, those most telling in that sample; a third of the sample never more. All texts are scored
whole.

Defined cases: null and empty texts have no sentence and the score of no evidence, that of one
sentence without features; repeated rows get equal scores; an empty table gives no rows; without labels
of both kinds, or without a telling feature, every score is 0; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.llm.sample import SAMPLE_ROWS, held_out, labelled_sample
from recordtrust.llm.text import U64, Texts, byte_values, chunks, mix, span_hash
from recordtrust.sources.workspace import Workspace

PREFIXES = (3, 4, 5, 6, 7, 8)
FOLD, REST, THRESHOLD = 3, 1, 0.7
LIFT, SURPRISE = 2, 1.92  # half the chi-square of one degree that chance exceeds once in 20


class Model(NamedTuple):
    """Sorted feature hashes, their weights, and the weight that every sentence has."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


class Tokens(NamedTuple):
    """Words of a chunk by sentence, and sentences by text."""

    hash: np.ndarray  # one row per kind of feature
    sentence: np.ndarray  # sentence of every word
    begin: np.ndarray  # first and last byte of every sentence
    end: np.ndarray
    row: np.ndarray  # text of every sentence


def _tables() -> tuple[np.ndarray, np.ndarray]:
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    stop = np.zeros(256, bool)
    stop[[ord(c) for c in ".!?\n"]] = True
    return letter, stop


LETTER, STOP = _tables()


def tokens_of(texts: Texts) -> Tokens:
    data, at = texts
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Tokens(np.zeros((1 + len(PREFIXES), 0), U64), none, none, none, none)
    letter = LETTER[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before, after = np.r_[False, letter[:-1]], np.r_[letter[1:], False]
    start = np.flatnonzero(letter & (~before | edge[:-1]))
    end = np.flatnonzero(letter & (~after | edge[1:])) + 1
    values = byte_values(True)[data]
    kinds = [span_hash(values, start, end)]
    for size in PREFIXES:
        kinds.append(mix(span_hash(values, start, np.minimum(end, start + size)) + U64(size)))
    # A sentence begins with a text and after a stop.
    first = edge[:-1].copy()
    first[1:] |= STOP[data[:-1]]
    begin = np.flatnonzero(first)
    return Tokens(
        np.array(kinds),
        np.searchsorted(begin, start, "right") - 1,
        begin,
        np.append(begin[1:], n),
        np.searchsorted(at, begin, "right") - 1,
    )


def _pairs(texts: Texts) -> tuple[np.ndarray, np.ndarray, Tokens]:
    """Sentence and feature hash of every feature occurrence; a short word has no longer beginnings."""
    tokens = tokens_of(texts)
    return np.tile(tokens.sentence, len(tokens.hash)), tokens.hash.ravel(), tokens


def feature_counts(sample: DataFrame) -> DataFrame:
    """Of how many toxic and other documents of the sample each feature is part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sentence, feature, tokens = _pairs(texts)
            label = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), np.int64)
            row = tokens.row[sentence]
            order = np.lexsort((row, feature))
            feature, row = feature[order], row[order]
            new = np.ones(len(row), bool)
            new[1:] = (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])
            distinct, where = np.unique(feature[new], return_inverse=True)
            toxic = np.bincount(where, label[row[new]], len(distinct)).astype(np.int64)
            total = np.bincount(where, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(toxic), pa.array(total)], names=["feature", "toxic", "n"])

    counts = sample.select("doc_id", "text", "label").mapInArrow(run, "feature long, toxic long, n long")
    return counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def telling_features(sample: DataFrame, n_features: int, toxic_share: float) -> np.ndarray:
    """The features whose documents are most surprisingly often toxic, by log-likelihood ratio.

    Their odds of being toxic are more than LIFT times those of the sample, which some documents can reach
    at any share of toxic ones, and chance would seldom do that (SURPRISE).
    """
    toxic, other = F.col("toxic"), F.col("n") - F.col("toxic")
    odds = toxic_share / (1 - toxic_share)
    surprise = toxic * F.log(toxic / (F.col("n") * toxic_share)) + F.when(other > 0, other * F.log(other / (F.col("n") * (1 - toxic_share)))).otherwise(0.0)
    best = (
        feature_counts(sample)
        .where((toxic >= 2) & (toxic > LIFT * odds * other))
        .where(surprise >= SURPRISE)
        .orderBy(surprise.desc(), "feature")
        .limit(n_features)
        .select("feature")
        .collect()  # at most n_features
    )
    return np.sort(np.array([r.feature for r in best], np.int64).view(U64))


def instances(sample: DataFrame, features: np.ndarray) -> DataFrame:
    """Of every sampled document: its label, its number of sentences, and the chosen features of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sentence, feature, tokens = _pairs(texts)
            at = np.minimum(np.searchsorted(features, feature), len(features) - 1)
            hit = features[at] == feature
            key = np.unique(sentence[hit] * len(features) + at[hit])
            sentence, at = key // len(features), key % len(features)
            row = tokens.row[sentence]
            first = np.searchsorted(tokens.row, np.arange(batch.num_rows))
            counts = np.bincount(tokens.row, minlength=batch.num_rows)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2).cast(pa.int32()),
                    pa.array(counts),
                    pa.array([(sentence[a:b] - first[row[a:b]]).astype(np.int32) for a, b in spans], pa.list_(pa.int32())),
                    pa.array([at[a:b].astype(np.int32) for a, b in spans], pa.list_(pa.int32())),
                ],
                names=["label", "n", "sentence", "feature"],
            )

    return sample.select("doc_id", "text", "label").mapInArrow(run, "label int, n long, sentence array<int>, feature array<int>")


def fit_noisy_or(label: np.ndarray, n: np.ndarray, document: np.ndarray, sentence: np.ndarray, feature: np.ndarray, n_features: int, rounds: int = 300, rate: float = 0.1, penalty: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the noisy-or likelihood.

    Sentences without a chosen feature are alike, so a document has a row per sentence with one, and
    a number of others.
    """
    keys, place = np.unique(document * (int(n.max(initial=0)) + 1) + sentence, return_inverse=True)
    owner = keys // (int(n.max(initial=0)) + 1)
    others = n - np.bincount(owner, minlength=len(n))
    weights, bias = np.zeros(n_features), -6.0
    state = [np.zeros(n_features + 1), np.zeros(n_features + 1)]
    for step in range(1, rounds + 1):
        score = np.bincount(place, weights[feature], len(keys)) + bias
        p, p0 = 1 / (1 + np.exp(-score)), 1 / (1 + np.exp(-bias))
        log_none = np.bincount(owner, -np.logaddexp(0, score), len(n)) - others * np.logaddexp(0, bias)
        none = np.exp(log_none)
        pull = np.where(label > 0, none / np.maximum(1 - none, 1e-12), -1.0)  # of one sentence, times its p
        per = pull[owner] * p
        slope = np.append(np.bincount(feature, per[place], n_features), per.sum() + (pull * others * p0).sum()) / len(n)
        slope[:-1] -= penalty * weights
        state = [0.9 * state[0] + 0.1 * slope, 0.999 * state[1] + 0.001 * slope**2]
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights + move[:-1], bias + move[-1]
    return weights, float(bias)


def fit(documents: DataFrame, labels: DataFrame, workspace: Workspace, sample_rows: int = SAMPLE_ROWS, n_features: int = 4096) -> Model:
    # Written once: the passes for the share, the features and the instances read sampled texts only.
    sample = workspace.stage(labelled_sample(documents, labels, "toxic", FOLD, REST, sample_rows), "sample")
    total, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    nothing = Model(np.zeros(1, U64), np.zeros(1), float("-inf"))
    if not total or not toxic or toxic == total:
        return nothing
    features = telling_features(sample, n_features, toxic / total)
    if not len(features):
        return nothing
    table = instances(sample, features).toArrow()  # at most sample_rows documents, chosen features only
    lists = [table.column(c).combine_chunks() for c in ("sentence", "feature")]
    sizes = np.array([len(x) for x in table.column("sentence")], np.int64)
    weights, bias = fit_noisy_or(
        table.column("label").to_numpy(),
        table.column("n").to_numpy(),
        np.repeat(np.arange(len(sizes)), sizes),
        *[np.asarray(x.flatten(), np.int64) for x in lists],
        len(features),
    )
    return Model(features, weights, bias)


def sentence_scores(texts: Texts, model: Model) -> tuple[np.ndarray, Tokens]:
    """Log odds of every sentence."""
    sentence, feature, tokens = _pairs(texts)
    at = np.minimum(np.searchsorted(model.features, feature), len(model.features) - 1)
    hit = model.features[at] == feature
    key = np.unique(sentence[hit] * len(model.features) + at[hit])
    per = np.bincount(key // len(model.features), model.weights[key % len(model.features)], len(tokens.begin))
    return per + model.bias, tokens


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and noisy-or score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            score, tokens = sentence_scores(texts, model)
            log_none = np.bincount(tokens.row, -np.logaddexp(0, score), batch.num_rows)
            log_none[np.bincount(tokens.row, minlength=batch.num_rows) == 0] = -np.logaddexp(0, model.bias)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(-np.expm1(log_none), 0, 1))], names=["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxic_sentences(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Sentences to blame: doc_id, sentence, score; a byte that is cut from its character is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            score, tokens = sentence_scores(texts, model)
            p = 1 / (1 + np.exp(-score))
            found = np.flatnonzero(p >= threshold)
            raw = texts.data.tobytes()
            said = [raw[a:b].decode("utf-8", "replace").strip() for a, b in zip(tokens.begin[found].tolist(), tokens.end[found].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(tokens.row[found])), pa.array(said, pa.string()), pa.array(p[found])], names=["doc_id", "sentence", "score"]
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, sentence string, score double")


def classify(documents: DataFrame, labels: DataFrame, workspace: Workspace) -> DataFrame:
    scored = score_documents(documents, fit(documents, labels, workspace))
    return scored.select(
        "doc_id", held_out(FOLD, REST).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
