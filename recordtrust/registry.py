"""Attributes, their comparators, and the column names derived from them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column

from recordtrust.functions.comparators import band, strict, within_days
from recordtrust.functions.names import names_agree

Comparator = Callable[[Column, Column], Column]


def _size(subject: Column, target: Column) -> Column:
    return band(subject, target, 0.95, 1.05)


def _term(subject: Column, target: Column) -> Column:
    return band(subject, target, 0.92, 1.08)


def _quarter(subject: Column, target: Column) -> Column:
    return within_days(subject, target, 90)


# Attribute names in report order, each with its agreement rule. Callers extend
# the engine by passing their own dict of the same form.
COMPARATORS: dict[str, Comparator] = {
    "tenant_name": names_agree,
    "space_type_id": strict,
    "transaction_size": _size,
    "starting_rent": strict,
    "execution_date": _quarter,
    "commencement_date": _quarter,
    "lease_term": _term,
    "expiration_date": _quarter,
    "work_value": strict,
    "free_months": strict,
    "transaction_type_id": strict,
    "rent_bumps_percent_bumps": strict,
    "rent_bumps_dollar_bumps": strict,
    "lease_type_id": strict,
}
ATTRIBUTES: tuple[str, ...] = tuple(COMPARATORS)

# The attributes whose reliabilities make up a submitter's general reliability.
GENERAL_ATTRIBUTES: tuple[str, ...] = (
    "tenant_name",
    "space_type_id",
    "transaction_size",
    "starting_rent",
    "execution_date",
    "commencement_date",
    "lease_term",
    "expiration_date",
)


class Entity(NamedTuple):
    """A key to profile by, how its profile joins back, and its short name in rate columns."""

    key: str
    how: str
    short: str


ENTITIES: tuple[Entity, ...] = (
    Entity("submitter_person_id", "inner", "submitter"),
    Entity("logo", "left", "logo"),
)


def rate_names(attributes: Iterable[str], entities: Iterable[Entity] = ENTITIES) -> list[str]:
    entities = list(entities)
    return [f"{a}_{e.short}_{kind}_rate" for a in attributes for e in entities for kind in ("correct", "fill")]


class NameGroups(NamedTuple):
    """Column names of the attributes by what they hold, each group in the order of the attributes."""

    correct: list[str]
    filled: list[str]
    label: list[str]


def name_groups(attributes: Iterable[str]) -> NameGroups:
    attributes = list(attributes)
    return NameGroups(*([f"{a}_{kind}" for a in attributes] for kind in NameGroups._fields))


def model_columns(columns: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split column names into model inputs (``...count``/``...rate``) and targets (``...label``)."""
    columns = list(columns)
    inputs = [c for c in columns if c.endswith(("count", "rate"))]
    targets = [c for c in columns if c.endswith("label")]
    return inputs, targets
