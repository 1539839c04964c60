"""Source relations of the pipeline, derived from the driver's tables.

The bodies are SQL that Spark and DuckDB both read; names in braces stand for tables. FIXTURES.md
explains the shapes they are meant to have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordtrust.sources.readers import conform
from recordtrust.sources.schemas import SCHEMAS
from recordtrust.sources.workspace import Workspace

GIVEN = ("customer", "supplier", "part", "orders", "lineitem")

BODIES: dict[str, str] = {
    "first_order": "SELECT o_custkey, min(o_orderdate) AS d0 FROM {orders} GROUP BY o_custkey",
    "first_supplier": "SELECT l_orderkey, min(l_suppkey) AS sk FROM {lineitem} GROUP BY l_orderkey",
    "slotted": """
        SELECT o_orderkey AS k, o_custkey AS m,
               o_custkey % (SELECT count(*) FROM {part}) AS slot,
               (o_custkey + o_orderkey) % (SELECT count(*) FROM {part}) AS pv
        FROM {orders}""",
    "base": """
        SELECT o.k, o.m, f.d0, c.c_acctbal AS bal, c.c_nationkey AS nk,
               p.p_partkey AS pk, p.p_retailprice AS rp, p.p_size AS sz, o.pv
        FROM {slotted} o
        JOIN {customer} c ON c.c_custkey = o.m
        JOIN {first_order} f ON f.o_custkey = o.m
        JOIN {part} p ON p.p_partkey = o.slot""",
    "mbase": "SELECT DISTINCT m, d0, bal, nk, pk, rp, sz FROM {base}",
    "comp_version": """
        SELECT o.o_orderkey AS id, s.sk AS submitter_person_id, 2 * o.o_orderkey AS comp_data_id
        FROM {orders} o LEFT JOIN {first_supplier} s ON s.l_orderkey = o.o_orderkey""",
    "comp_master": "SELECT m AS id, 2 * m + 1 AS comp_data_id FROM {mbase}",
    "comp_master_versions": "SELECT o_custkey AS comp_master_id, o_orderkey AS comp_version_id FROM {orders}",
    "comp_data": """
        SELECT 2 * k AS id,
          CASE k % 5 WHEN 0 THEN 3 * pk WHEN 1 THEN 3 * pk + 1 WHEN 2 THEN 3 * pv WHEN 3 THEN NULL
                     ELSE 3 * pk + 2 END AS tenant_id,
          CASE WHEN k % 7 = 0 THEN NULL ELSE bal * (1 + (CAST(k % 21 AS DOUBLE) - 10) / 100) END AS transaction_size,
          CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN rp + 1 ELSE rp END AS starting_rent,
          CASE WHEN k % 9 = 0 THEN NULL ELSE d0 + (k % 181 - 45) * INTERVAL '1' DAY END AS execution_date,
          CASE WHEN k % 8 = 0 THEN NULL ELSE d0 + (k % 151) * INTERVAL '1' DAY END AS commencement_date,
          CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(sz + 12 + k % 9 - 4 AS DOUBLE) END AS lease_term,
          CASE WHEN k % 10 = 0 THEN NULL ELSE d0 + (365 + k % 241 - 120) * INTERVAL '1' DAY END AS expiration_date,
          CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(sz AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS work_value,
          CASE WHEN k % 13 = 0 THEN NULL ELSE CAST((sz + k % 2) % 7 AS BIGINT) END AS free_months,
          CASE WHEN k % 12 = 0 THEN NULL ELSE (m + k % 3) % 4 END AS transaction_type_id,
          CASE WHEN k % 2 = 0 THEN NULL ELSE (m + k % 7) % 6 END AS rent_bumps_percent_bumps,
          CASE WHEN k % 2 = 1 THEN NULL ELSE (m + k % 5) % 10 END AS rent_bumps_dollar_bumps,
          CASE WHEN k % 14 = 0 THEN NULL ELSE (m + k % 4) % 3 END AS lease_type_id
        FROM {base}
        UNION ALL
        SELECT 2 * m + 1, CASE WHEN m % 17 = 0 THEN NULL ELSE 3 * pk END, bal, rp, d0,
          d0 + 30 * INTERVAL '1' DAY, CAST(sz + 12 AS DOUBLE), d0 + 365 * INTERVAL '1' DAY,
          CASE WHEN m % 3 = 0 THEN NULL ELSE CAST(sz AS DOUBLE) END,
          CAST(sz % 7 AS BIGINT), m % 4,
          CASE WHEN m % 5 = 0 THEN NULL ELSE m % 6 END,
          CASE WHEN m % 5 <> 0 THEN NULL ELSE m % 10 END,
          m % 3
        FROM {mbase}""",
    "comp_data_calculated_fields": """
        SELECT 2 * k AS comp_data_id,
          CAST(CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN nk + 1 ELSE nk END AS BIGINT) AS space_type_id
        FROM {base} WHERE k % 97 <> 0
        UNION ALL
        SELECT 2 * m + 1, CAST(nk AS BIGINT) FROM {mbase}""",
    "tenant": """
        SELECT 3 * p_partkey AS id, p_name AS name FROM {part}
        UNION ALL SELECT 3 * p_partkey + 1, concat(p_name, ' inc') FROM {part}
        UNION ALL SELECT 3 * p_partkey + 2, concat('the ', p_name) FROM {part}""",
    "comp_proposal": """
        SELECT l_orderkey AS comp_version_id, l_partkey AS comp_batch_id FROM {lineitem}""",
    "lease_tasks": "SELECT p_partkey AS batch_id, p_partkey AS submission_id FROM {part} WHERE p_size > 5",
    "submissions": "SELECT p_partkey AS id FROM {part} WHERE p_size > 10",
    "logo_detection_submission": """
        SELECT p_partkey AS id, p_brand AS logo, p_size % 4 AS logo_num FROM {part} WHERE p_size % 3 <> 0""",
    "person": """
        SELECT s_suppkey AS id, 'Supplier' AS first_name,
          CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_name END AS last_name
        FROM {supplier} WHERE s_suppkey % 13 <> 0""",
}

# base feeds four relations, so it is written once as well.
STAGED = ("base", *SCHEMAS)


def derive_sources(spark: SparkSession, sf_dir: str, workspace: Workspace) -> dict[str, DataFrame]:
    """The eleven source relations, written to the workspace and read back with declared types.

    ``logo_detection_submission`` keeps its numeric twin ``logo_num`` for the numeric-key variant.
    """
    frames = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in GIVEN}
    for name, body in BODIES.items():
        used = {n: df for n, df in frames.items() if "{" + n + "}" in body}
        frames[name] = spark.sql(body, **used)
        if name in STAGED:
            frames[name] = workspace.stage(frames[name], name)
    declared = {name: conform(frames[name], schema, name) for name, schema in SCHEMAS.items()}
    declared["logo_detection_submission"] = frames["logo_detection_submission"]
    return declared


def with_numeric_logo(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    logos = tables["logo_detection_submission"].selectExpr("id", "logo_num AS logo")
    return {**tables, "logo_detection_submission": logos}


def source_ctes() -> list[tuple[str, str]]:
    """The same relations as CTEs over tables of the given names."""
    names = {name: name for name in (*GIVEN, *BODIES)}
    return [(name, body.format(**names)) for name, body in BODIES.items()]
