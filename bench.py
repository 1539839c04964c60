"""Wall times of the headline queries; prints one JSON line.

Every query is written to Spark's noop sink, so all its rows and columns are computed. Source
tables are derived once before the clock starts; ``labels_all`` warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from catalog.queries import inputs, queries  # noqa: E402
from recordtrust.plans import job  # noqa: E402
from recordtrust.session import configured  # noqa: E402

HEADLINES = (
    "pairs_all",
    "pairs_reliable",
    "label_name_fuzzy",
    "labels_all",
    "profile_submitter",
    "profile_logo",
    "tally_cells",
    "combine_logo",
    "features_full",
    "submitter_report_order",
    "version_report_projection",
    "held_out_metrics",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configured(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}

    start = time.time()
    given = inputs(spark, sf_dir)
    derive = time.time() - start
    start = time.time()
    consume(known["labels_all"](spark, sf_dir))
    cold = time.time() - start
    # Shared intermediates, timed as steps of their own.
    for name, step in (
        ("stage_labelled", given.labelled),
        ("stage_populations", lambda: given.population(True)),
        ("fit_forests", given.fitted),
    ):
        start = time.time()
        step()
        times[name] = round(time.time() - start, 3)
    for name in HEADLINES:
        start = time.time()
        consume(known[name](spark, sf_dir))
        times[name] = round(time.time() - start, 3)
    start = time.time()
    job.run(spark, given.tables, given.workspace.path("out"), given.workspace)
    times["end_to_end"] = round(time.time() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "not_counted": {"derive_sources": round(derive, 3), "labels_all_cold": round(cold, 3)},
            }
        )
    )


if __name__ == "__main__":
    main()
