"""Entity profiles: how often an entity's values agreed with the master, per attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.functions.comparators import AGREE, DISAGREE, known
from recordtrust.registry import ATTRIBUTES, name_groups


def tally(
    labelled: DataFrame, keys: Sequence[str], attributes: Sequence[str] = ATTRIBUTES, fill_count: str = "rows"
) -> DataFrame:
    """Label counts per key combination, the one pass over the rows that everything else rests on.

    Partial sums are formed before the shuffle, so a key that holds most rows costs no more than
    any other. ``n`` counts rows and ``first_id`` is the lowest version id; present values are
    counted for ``fill_count="observed"`` only.
    """
    if fill_count not in ("rows", "observed"):
        raise ValueError("fill_count is 'rows' or 'observed'")
    sums = ["count(*) AS n", "min(id) AS first_id"]
    for a in attributes:
        sums += [
            f"count_if({a}_label = {AGREE}) AS {a}_agree",
            f"count_if({a}_label = {DISAGREE}) AS {a}_disagree",
        ]
        if fill_count == "observed":
            sums.append(f"sum(bigint({a}_filled)) AS {a}_seen")
    return labelled.groupBy(*keys).agg(*map(F.expr, sums))


def roll_up(tallied: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per coarser keys from counts per finer ones."""
    sums = ["sum(n) AS n", "min(first_id) AS first_id"]
    sums += [f"sum({c}) AS {c}" for c in tallied.columns if c.endswith(("_agree", "_disagree", "_seen"))]
    return tallied.groupBy(*keys).agg(*map(F.expr, sums))


def statistics(key: str, attributes: Sequence[str], fill_count: str = "rows", counts: str = "") -> list[str]:
    """An entity's statistics by name, as SQL over tally columns whose names end in ``counts``.

    By default the filled count is the row count, as the pipeline defines it; ``observed`` counts
    the values that were present.
    """
    columns, names = {}, name_groups(attributes)
    for a, correct, filled in zip(attributes, names.correct, names.filled, strict=True):
        columns[f"{correct}_{key}"] = f"{a}_agree{counts}"
        columns[f"{a}_total_{key}"] = f"n{counts}"
        columns[f"{filled}_{key}"] = f"n{counts}" if fill_count == "rows" else f"{a}_seen{counts}"
    return [f"{columns[c]} AS {c}" for c in sorted(columns)]


def profile(
    labelled: DataFrame, key: str, attributes: Sequence[str] = ATTRIBUTES, fill_count: str = "rows"
) -> DataFrame:
    """Correct, total and filled counts per entity and attribute; rows without the key are left out."""
    keyed = labelled.where(known(labelled, key).isNotNull())
    return tally(keyed, [key], attributes, fill_count).selectExpr(key, *statistics(key, attributes, fill_count))
