"""Pairs on hand-made tables: fan-out, null keys, inner-join loss and hot keys."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordtrust.operators.pairs import (
    build_pairs,
    labels_alone,
    linked_labels,
    linked_pairs,
    links_per_master,
    records,
    reliable_masters,
    reliable_pairs,
    version_logos,
)
from recordtrust.registry import COMPARATORS
from recordtrust.sources.schemas import SCHEMAS

DAY = datetime(2021, 5, 1)


def frame(spark, name, rows):
    schema = ", ".join(f"{c} {kind or 'string'}" for c, kind in SCHEMAS[name].items())
    return spark.createDataFrame(rows, schema)


def data_row(id, tenant=None, size=1.0):
    return (id, tenant, size, 2.0, DAY, DAY, 3.0, DAY, 4.0, 5, 6, 7, 8, 9)


@pytest.fixture
def tables(spark):
    """Versions 1-6 of masters 10 (four links), 20 (three links, one of them twice)."""
    rows = {
        "comp_version": [(1, 100, 11), (2, 100, 12), (3, None, 13), (4, 101, 14), (5, 101, 15), (6, 102, 16)],
        "comp_data": [data_row(i, tenant) for i, tenant in ((11, 1), (12, 2), (13, None), (14, 9), (15, 1), (16, 1))]
        + [data_row(91, 1), data_row(92, 2)],
        "comp_master": [(10, 91), (20, 92)],
        "comp_master_versions": [(10, 1), (10, 2), (10, 3), (10, 4), (20, 5), (20, 5), (20, 6)],
        "comp_proposal": [(1, 500), (1, 501), (1, 500), (2, 502), (3, None), (4, 503)],
        "lease_tasks": [(500, 700), (501, 701), (501, 702), (502, 799), (503, None)],
        "submissions": [(700,), (701,), (702,)],
        "logo_detection_submission": [(700, "A"), (701, "B"), (799, "C")],
        "tenant": [(1, "Acme"), (2, "Bolt")],
        "comp_data_calculated_fields": [(i, i % 2) for i in (11, 12, 13, 14, 15, 91, 92)],
        "person": [],
    }
    return {name: frame(spark, name, r) for name, r in rows.items()}


def test_fan_out_and_null_logos(tables):
    got = Counter((r.id, r.logo) for r in build_pairs(tables).collect())
    # 1: two equal proposals and one with two tasks, of which 702 has no logo; 2: submission 799 is
    # missing, so its logo does not count; 5 is linked twice; 6 has no calculated fields.
    assert got == {(1, "A"): 2, (1, "B"): 1, (1, None): 1, (2, None): 1, (3, None): 1, (4, None): 1, (5, None): 2}


def test_columns_and_tenants(tables):
    pairs = build_pairs(tables)
    assert len(pairs.columns) == 33
    by_id = {r.id: r for r in pairs.collect()}
    assert by_id[1].tenant_name_version == by_id[1].tenant_name_master == "Acme"
    assert by_id[3].tenant_name_version is None  # no tenant
    assert by_id[4].tenant_name_version is None  # tenant without a row
    assert by_id[2].comp_data_id_master == 91 and by_id[5].comp_data_id_master == 92


def test_reliable_masters_count_raw_links(tables):
    links = tables["comp_master_versions"]
    assert {r.comp_master_id: r.links for r in links_per_master(links).collect()} == {10: 4, 20: 3}
    assert [r[0] for r in reliable_masters(links).collect()] == [10]
    assert {r.id for r in reliable_pairs(tables).collect()} == {1, 2, 3, 4}
    assert {r.id for r in reliable_pairs(tables, min_links=2).collect()} == {1, 2, 3, 4, 5}


def test_duplicate_links_make_a_master_reliable(spark, tables):
    links = tables["comp_master_versions"].unionAll(frame(spark, "comp_master_versions", [(20, 6)]))
    assert {r.id for r in reliable_pairs({**tables, "comp_master_versions": links}).collect()} == {1, 2, 3, 4, 5}


def test_reliable_is_part_of_all(tables):
    everything = Counter(tuple(r) for r in build_pairs(tables).collect())
    assert not Counter(tuple(r) for r in reliable_pairs(tables).collect()) - everything


def test_attribute_subset(tables):
    assert build_pairs(tables, ["lease_term"]).columns[-2:] == ["lease_term_version", "lease_term_master"]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Every foreign key of 3,000 rows points to one value in a third of them, and to null in some."""
    ids = spark.range(3000)
    third = F.col("id") % 3 == 0

    def key(hot, null, other):
        return F.when(third, hot).when(F.col("id") % 10 == 1, null).otherwise(other).cast("long")

    none = F.lit(None)
    version = ids.select("id", key(5, none, F.col("id") % 40).alias("submitter_person_id"), (F.col("id") + 10_000).alias("comp_data_id"))
    template = [F.lit(v).alias(c) for c, v in zip(SCHEMAS["comp_data"], data_row(0)) if c not in ("id", "tenant_id", "transaction_size")]
    data = ids.select((F.col("id") + 10_000).alias("id"), key(1, none, F.col("id") % 60).alias("tenant_id"), F.col("id").cast("double").alias("transaction_size"), *template)
    master_data = spark.range(100).select((F.col("id") + 50_000).alias("id"), F.lit(1).cast("long").alias("tenant_id"), F.lit(1.0).alias("transaction_size"), *template)
    data = data.unionAll(master_data)
    made = {
        "comp_version": version,
        "comp_data": data,
        "comp_master": spark.range(100).select("id", (F.col("id") + 50_000).alias("comp_data_id")),
        "comp_master_versions": ids.select(key(7, F.lit(8), F.col("id") % 100).alias("comp_master_id"), F.col("id").alias("comp_version_id")).unionAll(
            spark.range(400).selectExpr("9 AS comp_master_id", "77 AS comp_version_id")
        ),
        "comp_proposal": ids.select(key(4, none, F.col("id")).alias("comp_version_id"), key(3, none, F.col("id") % 50).alias("comp_batch_id")),
        "lease_tasks": spark.range(300).select(
            F.when(F.col("id") < 100, 11).otherwise(F.col("id") - 100).cast("long").alias("batch_id"),
            F.when(F.col("id") % 3 == 0, 2).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 30).cast("long").alias("submission_id"),
        ),
        "submissions": spark.range(25),
        "logo_detection_submission": spark.range(2, 40).selectExpr("id", "concat('L', id % 5) AS logo"),
        "tenant": spark.range(50).selectExpr("id", "concat('T', id) AS name"),
        "comp_data_calculated_fields": data.selectExpr("id AS comp_data_id", "id % 4 AS space_type_id"),
    }
    root = tmp_path_factory.mktemp("skewed")
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in made}


def brute_force(skewed):
    rows = {n: [r.asDict() for r in df.collect()] for n, df in skewed.items() if n != "comp_data"}
    tasks, logos = {}, {r["id"]: r["logo"] for r in rows["logo_detection_submission"]}
    submissions = {r["id"] for r in rows["submissions"]}
    for t in rows["lease_tasks"]:
        sub = t["submission_id"]
        tasks.setdefault(t["batch_id"], []).append(logos.get(sub) if sub in submissions else None)
    proposals = {}
    for p in rows["comp_proposal"]:
        proposals.setdefault(p["comp_version_id"], []).extend(tasks.get(p["comp_batch_id"], [None]))
    tenants = {r["id"]: r["name"] for r in rows["tenant"]}
    tenant_of = {r.id: tenants.get(r.tenant_id) for r in skewed["comp_data"].select("id", "tenant_id").collect()}
    return Counter(
        (link["comp_version_id"], logo, link["comp_master_id"] + 50_000, tenant_of[link["comp_version_id"] + 10_000])
        for link in rows["comp_master_versions"]
        for logo in proposals.get(link["comp_version_id"], [None])
    )


@pytest.mark.parametrize("limits", [{}, {"taskRows": "100"}])
def test_hot_keys_everywhere(skewed, settings, limits):
    settings(**limits)
    got = build_pairs(skewed).select("id", "logo", "comp_data_id_master", "tenant_name_version")
    assert Counter(tuple(r) for r in got.collect()) == brute_force(skewed)


def test_parts_under_hot_keys(skewed, settings):
    plain = [Counter(tuple(r) for r in f(skewed).drop("proposal").collect()) for f in (records, version_logos, linked_pairs)]
    settings(taskRows="100")
    assert [Counter(tuple(r) for r in f(skewed).drop("proposal").collect()) for f in (records, version_logos, linked_pairs)] == plain


def test_names_are_compared_before_the_fan_out(tables):
    """Labels are made once per link: the logo join reads them."""
    plan = linked_pairs(tables, ["tenant_name"], {"tenant_name": COMPARATORS["tenant_name"]})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") > plan.index("Join LeftOuter, (id")


def test_labels_travel_without_values(tables, skewed, settings):
    """Values are neither written nor carried through the fan-out where labels alone are read; rows are the same."""
    comparators = {a: COMPARATORS[a] for a in ("tenant_name", "transaction_size")}
    for limits in ({}, {"taskRows": "100"}):
        settings(**limits)
        for given in (tables, skewed):
            found = linked_labels(given, comparators)
            assert not [c for c in found.columns if c.endswith(("_version", "_master"))]
            wide = linked_pairs(given, list(comparators), comparators).select(*found.columns)
            assert Counter(map(tuple, found.collect())) == Counter(map(tuple, wide.collect()))
    assert labels_alone(found).columns == found.columns


def test_queries_of_labels_stage_labels(spark, monkeypatch):
    """Counts of labels stage no values; a wide table that is there already is read instead."""
    from catalog import queries

    given, staged = queries.Inputs(spark, "/root/testdata/sf0.001"), []
    monkeypatch.setattr(queries, "inputs", lambda *_: given)
    stage = given.workspace.stage
    monkeypatch.setattr(given.workspace, "stage", lambda df, name: staged.append((name, df.columns)) or stage(df, name))
    for query in (queries.profile_logo, queries.rates, queries.submitter_report_order, queries.held_out_metrics, queries.exact_test_share, queries.binary_metrics):
        query(spark, "/root/testdata/sf0.001")
    assert not [name for name, columns in staged if "tenant_name_version" in columns]
    given.labelled()
    again = len(staged)
    assert set(given.marked().columns) < set(given.labelled().columns) and len(staged) == again
    given.workspace.close()
