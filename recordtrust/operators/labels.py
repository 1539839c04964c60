"""Tri-state labels: does a version's attribute agree with its master's?"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.functions.comparators import UNKNOWN, filled_flag, known
from recordtrust.registry import COMPARATORS, Comparator


def add_labels(pairs: DataFrame, comparators: Mapping[str, Comparator] = COMPARATORS) -> DataFrame:
    """Append ``_filled`` (0/1) and ``_label`` (-1/0/1) for every attribute in one projection."""
    columns = {}
    for attribute, compare in comparators.items():
        version = known(pairs, f"{attribute}_version")
        columns[f"{attribute}_filled"] = filled_flag(version)
        columns[f"{attribute}_label"] = compare(version, known(pairs, f"{attribute}_master"))
    return pairs.withColumns(columns)


def known_labels(labelled: DataFrame, label: str) -> DataFrame:
    """Rows whose label is not unknown: the training rows of one target."""
    return labelled.where(F.col(label) != UNKNOWN)


def label_distribution(labelled: DataFrame, attributes: Iterable[str]) -> DataFrame:
    """Rows per attribute and known label, from one pass that moves a single row of sums."""
    attributes = list(attributes)
    sums = labelled.agg(
        *[F.count_if(F.col(f"{a}_label") == value).alias(f"{a}_{value}") for a in attributes for value in (0, 1)]
    )
    cells = [
        F.struct(F.lit(a).alias("attribute"), F.lit(v).alias("label"), F.col(f"{a}_{v}").alias("n"))
        for a in attributes
        for v in (0, 1)
    ]
    return sums.select(F.inline(F.array(*cells))).where("n > 0")
