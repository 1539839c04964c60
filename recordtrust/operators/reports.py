"""Reliability reports per submitter and per version."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.operators.features import fill_zero, rows_with_cell
from recordtrust.operators.forests import Forests, score
from recordtrust.operators.joins import attach
from recordtrust.operators.vectors import SUBMITTER, submitter_records
from recordtrust.registry import ATTRIBUTES, ENTITIES, GENERAL_ATTRIBUTES, Entity
from recordtrust.sources.workspace import Workspace


def mean_of(columns: Sequence[str]) -> Column:
    return reduce(Column.__add__, [F.col(c) for c in columns]) / len(columns)


def rank_submitters(scored: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Name ``_prob`` columns as reliabilities, add the general one, order best first.

    The general reliability is the mean over those of GENERAL_ATTRIBUTES that are given, or over all
    given attributes if there are none of them.
    """
    named = scored.select(
        "submitter_name",
        SUBMITTER,
        "n_support",
        *[F.col(f"{a}_prob").alias(f"{a}_reliability") for a in attributes],
    )
    general = mean_of([f"{a}_reliability" for a in [g for g in GENERAL_ATTRIBUTES if g in attributes] or attributes])
    return named.withColumn("general_reliability", general).orderBy(
        F.desc("general_reliability"), F.desc("n_support"), F.asc(SUBMITTER)
    )


def submitter_report(
    cells: DataFrame,
    inputs: Sequence[str],
    models: Forests,
    names: DataFrame,
    workspace: Workspace,
    attributes: Sequence[str] = ATTRIBUTES,
) -> DataFrame:
    """Reliability of every named submitter, scored on one vector each."""
    return rank_submitters(score(submitter_records(cells, inputs, names), models, workspace), attributes)


def version_rows(
    labelled: DataFrame,
    scored_cells: DataFrame,
    attributes: Sequence[str] = ATTRIBUTES,
    entities: Sequence[Entity] = ENTITIES,
) -> DataFrame:
    """Versions with the scores of their cell, ordered by master and then version.

    ``scored_cells`` holds the entity keys, ``n`` and a ``_prob`` per attribute. Rows of cells
    without scores (no submitter) drop out; missing numbers read 0 as in the feature frame. Pass
    staged rows: their row number is the last sort key, so that equal rows can be sorted apart.
    """
    keys = [e.key for e in entities]
    ids = ["comp_data_id_version", "comp_data_id_master"]
    row = F.monotonically_increasing_id().alias("__position")
    rows = labelled.select(*keys, *ids, *[f"{a}_version" for a in attributes], row)
    probabilities = scored_cells.select(*keys, "n", *[f"{a}_prob" for a in attributes])
    joined = fill_zero(attach(rows_with_cell(rows, entities), probabilities, keys, "inner", "n", null_safe=True))
    interleaved = [c for a in attributes for c in (f"{a}_version", f"{a}_prob")]
    ordered = joined.orderBy(
        F.asc_nulls_last("comp_data_id_master"), F.asc_nulls_last("comp_data_id_version"), "__position"
    )
    return ordered.select(*ids, *interleaved)


def score_cells(
    cells: DataFrame, models: Forests, workspace: Workspace, entities: Sequence[Entity] = ENTITIES
) -> DataFrame:
    """Scores per cell: every row of a cell has the same inputs, so rows are never scored."""
    keys = [e.key for e in entities]
    return score(cells, models, workspace).select(*keys, "n", *[f"{c.removesuffix('_label')}_prob" for c in models.labels])
