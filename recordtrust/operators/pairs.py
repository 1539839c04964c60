"""Version/master pairs: every version's attributes next to those of its master.

Rows of hot keys are dealt by a row id, or where a table has none by a hash of the row and its place among equal
rows. Both depend on content alone, so a task that is run again deals alike on any source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.operators.joins import hot_keys, numbered, spread_join
from recordtrust.operators.labels import add_labels
from recordtrust.registry import ATTRIBUTES, COMPARATORS, Comparator
from recordtrust.sources.readers import Tables

MIN_LINKS = 3


def links_per_master(links: DataFrame) -> DataFrame:
    return links.groupBy("comp_master_id").agg(F.count(F.lit(1)).alias("links"))


def reliable_masters(links: DataFrame, min_links: int = MIN_LINKS) -> DataFrame:
    """Masters with more raw link rows than ``min_links``, counted before any join."""
    return links_per_master(links).where(F.col("links") > min_links).select("comp_master_id")


def records(tables: Tables, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """One row per record: its data, its tenant's name and its calculated fields.

    Records without calculated fields drop out, those without a tenant stay.
    """
    data, tenant = tables["comp_data"], tables["tenant"]
    named = spread_join(
        data,
        tenant.select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name")),
        ["tenant_id"],
        "left",
        left_hot=hot_keys(data.select("tenant_id"), ["tenant_id"]),
        left_row=F.xxhash64("id"),
    )
    calculated = tables["comp_data_calculated_fields"].withColumnRenamed("comp_data_id", "id")
    return named.join(calculated, "id").select(F.col("id").alias("comp_data_id"), *attributes)


def _suffixed(df: DataFrame, attributes: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in ("comp_data_id", *attributes)})


def version_logos(tables: Tables) -> DataFrame:
    """Logo of every submission a version came in by: one row per proposal and task.

    A proposal without a task, and a task whose submission or logo is missing, give a null logo.
    ``proposal`` numbers the proposals.
    """
    proposals, tasks = tables["comp_proposal"], tables["lease_tasks"]
    often_submitted = hot_keys(tasks.select("submission_id"), ["submission_id"])
    often_proposed = hot_keys(proposals.select("comp_batch_id"), ["comp_batch_id"])
    often_batched = hot_keys(tasks.select(F.col("batch_id").alias("comp_batch_id")), ["comp_batch_id"])
    proposals = numbered(proposals, "proposal", often_proposed, hot_keys(proposals.select("comp_version_id"), ["comp_version_id"]))
    tasks = numbered(tasks, "task", often_submitted, often_batched)
    logos = tables["submissions"].join(tables["logo_detection_submission"], "id", "left")
    task_logos = spread_join(
        tasks,
        logos.withColumnRenamed("id", "submission_id"),
        ["submission_id"],
        "left",
        left_hot=often_submitted,
        left_row=F.col("task"),
    ).select(F.col("batch_id").alias("comp_batch_id"), "logo", "task")
    return spread_join(
        proposals,
        task_logos,
        ["comp_batch_id"],
        "left",
        left_hot=often_proposed,
        right_hot=often_batched,
        left_row=F.col("proposal"),
        right_row=F.col("task"),
    ).select(F.col("comp_version_id").alias("id"), "logo", "proposal")


def linked_pairs(
    tables: Tables, attributes: Sequence[str] = ATTRIBUTES, comparators: Mapping[str, Comparator] | None = None
) -> DataFrame:
    """All pairs, with the number of link rows of the master in ``master_links``.

    ``comparators`` add labels. Those depend on version and master only, so they are made once per
    link, before the fan-out by logo.

    Masters are completed first, on their own; links meet them on the master id and versions and
    logos meet those on the version id, so the last two joins share one partitioning and the
    fan-out by logo happens after every shuffle of wide rows.
    """
    attributes = list(attributes)
    links = tables["comp_master_versions"].select("comp_master_id", F.col("comp_version_id").alias("id"))
    often_linked, large_masters = hot_keys(links.select("id"), ["id"]), hot_keys(links.select("comp_master_id"), ["comp_master_id"])
    counted = links_per_master(links)
    links = numbered(links, "link", often_linked, large_masters)
    described = records(tables, attributes)

    masters = (
        tables["comp_master"]
        .withColumnsRenamed({"id": "comp_master_id"})
        .join(described, "comp_data_id")
        .join(counted.withColumnRenamed("links", "master_links"), "comp_master_id")
    )
    linked = spread_join(
        links,
        _suffixed(masters, attributes, "master"),
        ["comp_master_id"],
        left_hot=large_masters,
        left_row=F.col("link"),
    )
    versions = _suffixed(
        spread_join(
            tables["comp_version"],
            described,
            ["comp_data_id"],
            left_hot=hot_keys(tables["comp_version"].select("comp_data_id"), ["comp_data_id"]),
            left_row=F.xxhash64("id"),
        ),
        attributes,
        "version",
    )
    proposals = tables["comp_proposal"].select(F.col("comp_version_id").alias("id"))
    compared = spread_join(linked, versions, ["id"], left_hot=often_linked, left_row=F.col("link"))
    if comparators:
        compared = add_labels(compared, comparators)
    return spread_join(
        compared,
        version_logos(tables),
        ["id"],
        "left",
        left_hot=often_linked,
        right_hot=hot_keys(proposals, ["id"]),
        left_row=F.col("link"),
        right_row=F.col("proposal"),
    ).select(
        "id",
        "submitter_person_id",
        "logo",
        "comp_data_id_version",
        "comp_data_id_master",
        *[f"{a}_{side}" for side in ("version", "master") for a in attributes],
        "master_links",
        *[f"{a}_{kind}" for a in comparators or () for kind in ("filled", "label")],
    )


def labels_alone(labelled: DataFrame) -> DataFrame:
    """Labelled pairs without the records' ids and values."""
    kept = [c for c in labelled.columns if not c.endswith(("_version", "_master"))]
    return labelled.select(*kept)


def linked_labels(tables: Tables, comparators: Mapping[str, Comparator] = COMPARATORS) -> DataFrame:
    """The labels of all pairs: values are dropped before the fan-out by logo, and not shuffled for it."""
    return labels_alone(linked_pairs(tables, list(comparators), comparators))


def build_pairs(tables: Tables, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    return linked_pairs(tables, attributes).drop("master_links")


def reliable(pairs: DataFrame, min_links: int = MIN_LINKS) -> DataFrame:
    """Pairs of masters with enough links; the test moves down to the master side of the plan."""
    return pairs.where(F.col("master_links") > min_links).drop("master_links")


def reliable_pairs(tables: Tables, attributes: Sequence[str] = ATTRIBUTES, min_links: int = MIN_LINKS) -> DataFrame:
    return reliable(linked_pairs(tables, attributes), min_links)
