from __future__ import annotations

from pyspark.sql import functions as F

from catalog.sample import derive_sources
from recordtrust.operators.forests import load_models
from recordtrust.plans.job import run
from recordtrust.registry import ATTRIBUTES, COMPARATORS
from recordtrust.sources.workspace import Workspace

SF_DIR = "/root/testdata/sf0.001"


def test_job_writes_models_metrics_and_reports(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "work"))
    tables = derive_sources(spark, SF_DIR, workspace)
    out = str(tmp_path / "out")
    assert run(spark, tables, out, workspace, trees=3, depth=3, exact=True) == {"reliable": 5945, "all": 5959}

    found = load_models(spark, f"{out}/models", ATTRIBUTES)
    assert len(found.labels) == 14 and found.trees.groupBy("label").count().where("count = 3").count() == 14
    metrics = spark.read.csv(f"{out}/metrics", header=True, inferSchema=True)
    assert metrics.count() == 14 and metrics.where("accuracy < 0 OR accuracy > 1").count() == 0

    submitters = spark.read.csv(f"{out}/submitter_reliability", header=True, inferSchema=True)
    assert len(submitters.columns) == 18 and submitters.count() == 9
    versions = spark.read.csv(f"{out}/version_reliability", header=True, inferSchema=True)
    assert len(versions.columns) == 30 and versions.count() == 5933
    assert versions.where("tenant_name_version = '0'").count() > 0
    assert versions.where("tenant_name_prob NOT BETWEEN 0 AND 1").count() == 0


def test_job_takes_own_comparators(spark, tmp_path):
    """One attribute fewer, and one that always agrees."""
    workspace = Workspace(spark, str(tmp_path / "work"))
    tables = derive_sources(spark, SF_DIR, workspace)
    out = str(tmp_path / "out")
    own = {a: COMPARATORS[a] for a in ("tenant_name", "lease_type_id")}
    own["lease_term"] = lambda version, master: F.when(version.isNull() | master.isNull(), -1).otherwise(1)
    run(spark, tables, out, workspace, trees=2, comparators=own)

    metrics = {r.attribute: r for r in spark.read.csv(f"{out}/metrics", header=True, inferSchema=True).collect()}
    assert set(metrics) == set(own) and metrics["lease_term"].accuracy == 1
    submitters = spark.read.csv(f"{out}/submitter_reliability", header=True, inferSchema=True)
    assert [c for c in submitters.columns if c.endswith("_reliability")] == [*[f"{a}_reliability" for a in own], "general_reliability"]
    assert submitters.where("abs(general_reliability - (tenant_name_reliability + lease_term_reliability) / 2) > 1e-9").count() == 0
    versions = spark.read.csv(f"{out}/version_reliability", header=True)
    assert len(versions.columns) == 2 + 2 * len(own) and versions.count() == 5933
