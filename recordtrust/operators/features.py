"""Features of a row: the profiles of its entities, their history without the row, and rates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtrust.functions.comparators import known
from recordtrust.operators.joins import BROADCAST_BYTES, attach, byte_size, hot_keys, setting, spread_join
from recordtrust.operators.profile import roll_up, statistics, tally
from recordtrust.registry import ATTRIBUTES, ENTITIES, Entity
from recordtrust.sources.workspace import Workspace


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN numbers become 0, null booleans false; text and dates stay null."""
    kinds = {f.name: f.dataType for f in df.schema if columns is None or f.name in columns}
    numbers = [c for c, kind in kinds.items() if isinstance(kind, T.NumericType)]
    flags = [c for c, kind in kinds.items() if isinstance(kind, T.BooleanType)]
    df = df.na.fill(0, subset=numbers) if numbers else df
    return df.na.fill(False, subset=flags) if flags else df


def _only_key_shared(columns: Iterable[str], stats: DataFrame, key: str) -> None:
    shared = set(columns) & set(stats.columns)
    if shared != {key}:
        raise ValueError(f"only {key} may be shared, found {sorted(shared)}")


def history(key: str, attributes: Sequence[str]) -> list[str]:
    """Counts without the row itself, as SQL. An unknown label (-1) adds one to the correct history."""
    columns = []
    for a in attributes:
        columns += [
            f"{a}_correct_{key} - {a}_label AS {a}_correct_{key}_hist",
            f"{a}_total_{key} - 1 AS {a}_total_{key}_hist",
            f"{a}_filled_{key} - {a}_filled AS {a}_filled_{key}_hist",
        ]
    return columns


def _repeats(stats: DataFrame, weight: str) -> list[str]:
    """Whole-number columns of a per-key table that equal its ``weight`` in every row."""
    kinds = {f.name: f.dataType for f in stats.schema}
    others = [c for c, kind in kinds.items() if c != weight and kind == kinds[weight] and isinstance(kind, T.IntegralType)]
    if not others:
        return []
    equal = stats.agg(*[F.every(F.col(c).eqNullSafe(F.col(weight))).alias(c) for c in others]).first()
    return [c for c in others if equal[c]]


def combine(
    df: DataFrame, stats: DataFrame, key: str, how: str = "inner", attributes: Sequence[str] = ATTRIBUTES
) -> DataFrame:
    """Join an entity profile to the rows, add histories, then fill zeros.

    The fill covers the whole frame, so a numeric key left null here is 0 in the next combine and
    meets the profile of 0 there, while a null text key meets nothing.
    """
    _only_key_shared(df.columns, stats, key)
    weight = f"{attributes[0]}_total_{key}"
    return fill_zero(attach(df, stats, [key], how, weight).selectExpr("*", *history(key, attributes)))


def combine_all(
    df: DataFrame, profiles: Sequence[DataFrame], entities: Sequence[Entity], attributes: Sequence[str] = ATTRIBUTES
) -> DataFrame:
    """What a ``combine`` per entity gives, one after the other; all joins come before the rows get wide.

    Most statistics of a profile repeat its row count (totals, and filled counts unless present values are counted).
    Those are looked for in the profile, left out of the join and named again behind it. Pass staged profiles: they
    are read more than once.
    """
    seen, joined = list(df.columns), df.selectExpr("*", *[f"{e.key} AS __{e.key}" for e in entities])
    named, carried = [], []  # by entity: what follows the join, and what goes through it
    for position, (e, stats) in enumerate(zip(entities, profiles, strict=True)):
        _only_key_shared(seen, stats, e.key)
        own, weight = f"__{e.key}", f"{attributes[0]}_total_{e.key}"
        if position:  # the combine before has filled the frame by now
            joined = fill_zero(joined, [own])
        statistic, repeats = [c for c in stats.columns if c != e.key], _repeats(stats.drop(e.key), weight)
        joined = attach(joined, stats.drop(*repeats).withColumnRenamed(e.key, own), [own], e.how, weight)
        named.append([*[f"{weight} AS {c}" if c in repeats else c for c in statistic], *history(e.key, attributes)])
        carried.append([c for c in statistic if c not in repeats])
        seen += statistic
    known_by_now = df.columns
    for position, columns in enumerate(named):
        later = [c for x in carried[position + 1 :] for c in x]
        wide = joined.selectExpr(*known_by_now, *columns, *later)
        known_by_now = wide.columns[: len(wide.columns) - len(later)]
        joined = fill_zero(wide, known_by_now)
    return joined


def _ratio(part: str, whole: str) -> str:
    return f"if({whole} > 0, {part} / {whole}, 0D)"


def rates(attributes: Sequence[str] = ATTRIBUTES, entities: Sequence[Entity] = ENTITIES) -> list[str]:
    """Correct and fill rate of every attribute and entity, as SQL; 0 where there is nothing to divide by."""
    columns = []
    for a in attributes:
        for e in entities:
            correct, filled, total = (f"{a}_{stat}_{e.key}" for stat in ("correct", "filled", "total"))
            columns += [
                f"{_ratio(correct, filled)} AS {a}_{e.short}_correct_rate",
                f"{_ratio(filled, total)} AS {a}_{e.short}_fill_rate",
            ]
    return columns


def add_rates(
    df: DataFrame, attributes: Sequence[str] = ATTRIBUTES, entities: Sequence[Entity] = ENTITIES
) -> DataFrame:
    return df.selectExpr("*", *rates(attributes, entities))


def _counts_of(key: str) -> str:
    return f"_of_{key}"


def entity_counts(tallied: DataFrame, entity: Entity) -> DataFrame:
    """An entity's label counts from those of finer keys; its key is renamed, the columns are marked as its own."""
    counts = roll_up(tallied.where(known(tallied, entity.key).isNotNull()), [entity.key]).drop("first_id")
    renamed = [f"{c} AS {c}{_counts_of(entity.key)}" for c in counts.columns if c != entity.key]
    return counts.selectExpr(f"{entity.key} AS __{entity.key}", *renamed)


def cell_profiles(tallied: DataFrame, entities: Sequence[Entity] = ENTITIES) -> DataFrame:
    """One row per cell (combination of entity keys) with the label counts of all its entities.

    A row's features depend on its cell and its own labels only, so profiles meet here, on one row
    per cell, and not on the rows. Cells carry their original keys, ``n`` and ``first_id``.
    """
    keys = [e.key for e in entities]
    joined = roll_up(tallied, keys).selectExpr(*keys, "n", "first_id", *[f"{k} AS __{k}" for k in keys])
    for position, e in enumerate(entities):
        own = f"__{e.key}"
        if position:  # the first combine has filled the frame by now
            joined = fill_zero(joined, [own])
        joined = spread_join(joined, entity_counts(tallied, e), [own], e.how, left_hot=hot_keys(joined.select(own), [own]))
    return joined.drop(*[f"__{k}" for k in keys])


def look_up(df: DataFrame, counts: Sequence[DataFrame], entities: Sequence[Entity]) -> DataFrame:
    """Rows with the counts of their entities, each table broadcast: what ``cell_profiles`` would tell them, without a shuffle."""
    keys = [e.key for e in entities]
    joined = df.selectExpr("*", *[f"{k} AS __{k}" for k in keys])
    for position, (e, table) in enumerate(zip(entities, counts, strict=True)):
        own = f"__{e.key}"
        if position:
            joined = fill_zero(joined, [own])
        joined = spread_join(joined, F.broadcast(table), [own], e.how)
    return joined.drop(*[f"__{k}" for k in keys])


def _all_statistics(attributes: Sequence[str], entities: Sequence[Entity], fill_count: str) -> list[str]:
    return [s for e in entities for s in statistics(e.key, attributes, fill_count, _counts_of(e.key))]


def cell_rates(
    cells: DataFrame,
    attributes: Sequence[str] = ATTRIBUTES,
    entities: Sequence[Entity] = ENTITIES,
    fill_count: str = "rows",
) -> DataFrame:
    """Cells with their rates: keys, ``n``, ``first_id``, rates."""
    own = [*[e.key for e in entities], "n", "first_id"]
    filled = fill_zero(cells, [c for c in cells.columns if c not in own])
    named = filled.selectExpr(*own, *_all_statistics(attributes, entities, fill_count))
    return named.selectExpr(*own, *rates(attributes, entities))


def rows_with_cell(df: DataFrame, entities: Sequence[Entity] = ENTITIES) -> DataFrame:
    """Rows that can have a cell: those whose first entity is known, if it is joined inner.

    The join with the cells would drop the others too, but only after all of them met in one task.
    """
    first = entities[0]
    return df.where(known(df, first.key).isNotNull()) if first.how == "inner" else df


def _without_disagree(counts: DataFrame) -> DataFrame:
    return counts.select([c for c in counts.columns if "_disagree_of_" not in c])


def build_features(
    labelled: DataFrame,
    attributes: Sequence[str] = ATTRIBUTES,
    entities: Sequence[Entity] = ENTITIES,
    fill_count: str = "rows",
    workspace: Workspace | None = None,
) -> DataFrame:
    """Profile every entity, join the profiles to the rows, add histories and rates.

    Profiles always come from the rows as given, before any row is dropped for a missing key. The
    join carries the plain counts; the statistics are named after it. An entity has far fewer keys than there are
    cells, so profiles that are small together are looked up one by one and the rows stay where they are. Larger ones meet on
    cells first, and the rows meet those at once. Pass staged rows: they are read twice. Where cells are hot, rows are
    written with a number to deal them by.
    """
    workspace = workspace or Workspace(labelled.sparkSession)
    keys = [e.key for e in entities]
    tallied = workspace.stage(tally(labelled, keys, attributes, fill_count), "tally")
    found = rows_with_cell(labelled, entities)
    counts = [workspace.stage(_without_disagree(entity_counts(tallied, e)), f"counts-{e.key}") for e in entities]
    if sum(map(byte_size, counts)) <= setting(labelled.sparkSession, BROADCAST_BYTES):
        rows = look_up(found, counts, entities)
    else:
        cells = workspace.stage(_without_disagree(cell_profiles(tallied, entities).drop("first_id")), "cells")
        rows = attach(found, cells, keys, "inner", "n", null_safe=True, workspace=workspace)
    combined = rows.selectExpr(*labelled.columns, *_all_statistics(attributes, entities, fill_count))
    histories = [column for e in entities for column in history(e.key, attributes)]
    return add_rates(fill_zero(combined.selectExpr("*", *histories)), attributes, entities)
