"""Registered queries: each takes a session and a folder of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.oracle import DATES, FIXED_TREES, LABEL_COLUMNS, NUMERIC, PAIR_COLUMNS, STRICT
from catalog.sample import derive_sources, with_numeric_logo
from recordtrust.functions.comparators import within_days
from recordtrust.functions.dates import parse_date
from recordtrust.operators import features, forests, joins, labels, metrics, pairs, profile, reports, vectors
from recordtrust.plans import job
from recordtrust.registry import ATTRIBUTES, COMPARATORS, ENTITIES, GENERAL_ATTRIBUTES, model_columns, rate_names
from recordtrust.sources import readers, sinks
from recordtrust.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

KEYS = [e.key for e in ENTITIES]
SUB, LOGO = KEYS
INPUTS = rate_names(ATTRIBUTES)


class Inputs:
    """What the queries of one session and folder share: source tables, labels, cells, forests.

    Every part is written to the workspace when a query first asks for it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.workspace, self._wide = Workspace(spark), {}
        self.tables = derive_sources(spark, sf_dir.rstrip("/"), self.workspace)

    def _tables(self, numeric_logo: bool) -> dict[str, DataFrame]:
        return with_numeric_logo(self.tables) if numeric_logo else self.tables

    def labelled(self, numeric_logo: bool = False) -> DataFrame:
        if numeric_logo not in self._wide:
            self._wide[numeric_logo] = job.label_pairs(self._tables(numeric_logo), self.workspace)
        return self._wide[numeric_logo]

    @cache
    def _marked(self, numeric_logo: bool) -> DataFrame:
        return self.workspace.stage(pairs.linked_labels(self._tables(numeric_logo)), "marked")

    def marked(self, numeric_logo: bool = False) -> DataFrame:
        """As ``labelled`` without the compared values: most queries read labels alone, and values are most of the bytes."""
        if numeric_logo in self._wide:
            return pairs.labels_alone(self._wide[numeric_logo])
        return self._marked(numeric_logo)

    def marked_rows(self, numeric_logo: bool = False) -> DataFrame:
        return self.marked(numeric_logo).drop("master_links")

    def marked_reliable(self) -> DataFrame:
        return pairs.reliable(self.marked())

    def all_rows(self, numeric_logo: bool = False) -> DataFrame:
        return self.labelled(numeric_logo).drop("master_links")

    def reliable_rows(self) -> DataFrame:
        return pairs.reliable(self.labelled())

    @cache
    def _populations(self) -> tuple[job.Population, job.Population]:
        return job.populations(self.marked(), self.workspace)

    def population(self, only_reliable: bool) -> job.Population:
        reliable, everyone = self._populations()
        return reliable if only_reliable else everyone

    @cache
    def profile(self, key: str, numeric_logo: bool) -> DataFrame:
        return self.workspace.stage(profile.profile(self.marked_rows(numeric_logo), key), f"profile-{key}")

    def combined(self, numeric_logo: bool = False, values: bool = True) -> DataFrame:
        rows = self.all_rows(numeric_logo) if values else self.marked_rows(numeric_logo)
        return features.combine_all(rows, [self.profile(key, numeric_logo) for key in KEYS], ENTITIES)

    @cache
    def fitted(self) -> tuple[forests.Forests, DataFrame]:
        return job.fit(self.population(True), self.workspace)


_inputs: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _inputs:
        _inputs[key] = Inputs(spark, sf_dir)
    return _inputs[key]


def pairs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.build_pairs(inputs(spark, sf_dir).tables)


def pairs_reliable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.reliable_pairs(inputs(spark, sf_dir).tables)


def pairs_from_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair query as SQL text over the source tables, as a warehouse user would send it."""
    names = ["comp_data_id", *ATTRIBUTES]
    version, master = (", ".join(f"{side}.{c} AS {c}_{side}" for c in names) for side in ("version", "master"))
    sql = f"""
        WITH record AS (
          SELECT d.id AS comp_data_id, t.name AS tenant_name, c.space_type_id, d.* EXCEPT (id, tenant_id)
          FROM {{comp_data}} d
          JOIN {{comp_data_calculated_fields}} c ON c.comp_data_id = d.id
          LEFT JOIN {{tenant}} t ON t.id = d.tenant_id
        ), reliable AS (
          SELECT comp_master_id FROM {{comp_master_versions}} GROUP BY comp_master_id HAVING count(*) > 3
        ), sent AS (
          SELECT p.comp_version_id, found.logo
          FROM {{comp_proposal}} p
          LEFT JOIN {{lease_tasks}} task ON task.batch_id = p.comp_batch_id
          LEFT JOIN ({{submissions}} s JOIN {{logo_detection_submission}} found ON found.id = s.id)
            ON s.id = task.submission_id
        ), described AS (
          SELECT v.id, v.submitter_person_id, sent.logo, {version}, {master}
          FROM {{comp_master_versions}} link
          LEFT SEMI JOIN reliable ON reliable.comp_master_id = link.comp_master_id
          JOIN {{comp_master}} m ON m.id = link.comp_master_id
          JOIN record master ON master.comp_data_id = m.comp_data_id
          JOIN {{comp_version}} v ON v.id = link.comp_version_id
          JOIN record version ON version.comp_data_id = v.comp_data_id
          LEFT JOIN sent ON sent.comp_version_id = v.id
        )
        SELECT {", ".join(PAIR_COLUMNS)} FROM described"""
    return readers.read_query(tables=inputs(spark, sf_dir).tables, sql=sql)


def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs(spark, sf_dir).marked()
    return rows.agg(
        F.count_if(F.col("master_links") > pairs.MIN_LINKS).alias("reliable_rows"),
        F.count(F.lit(1)).alias("all_rows"),
    )


def links_per_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.links_per_master(inputs(spark, sf_dir).tables["comp_master_versions"])


def reliable_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.reliable_masters(inputs(spark, sf_dir).tables["comp_master_versions"])


def submitter_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.submitter_names(inputs(spark, sf_dir).tables["person"])


def _label_query(attributes: list[str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        comparators = {a: COMPARATORS[a] for a in attributes}
        labelled = pairs.linked_pairs(inputs(spark, sf_dir).tables, attributes, comparators)
        columns = [f"{a}_{kind}" for a in attributes for kind in ("version", "master", "filled", "label")]
        return labelled.select("id", "logo", *columns)

    return query


# How dates are written: ISO with time and zone, with slashes, compact, with names of months and weekdays.
DATE_SHAPES = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "MMM d, yyyy", "M/d/yyyy h:mm a", "MMMM d, yyyy", "yyyy/MM/dd HH:mm", "yyyyMMdd",
    "yyyyMMdd'T'HHmmss", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "EEEE, d MMMM yyyy", "d-MMM-yy HH:mm:ss 'GMT'", "yyyy-MM-dd'T'HH:mm:ss'Z'",
)


def parse_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs.build_pairs(inputs(spark, sf_dir).tables, ["execution_date"])
    date, shape = F.col("execution_date_version"), F.pmod(F.col("id"), F.lit(len(DATE_SHAPES) + 1))
    text = F.concat(F.lit("unread "), F.col("id").cast("string"))
    for i, pattern in enumerate(DATE_SHAPES):
        text = F.when(shape == i, F.date_format(date, pattern)).otherwise(text)
    parsed = rows.withColumn("execution_text", text).withColumn("execution_parsed", parse_date(F.col("execution_text")))
    label = within_days(F.col("execution_parsed"), F.col("execution_date_master"), 90)
    return parsed.select("id", "logo", "execution_text", "execution_parsed", label.alias("execution_label"))


def labels_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs.linked_pairs(inputs(spark, sf_dir).tables, ATTRIBUTES, COMPARATORS)
    return rows.select(*PAIR_COLUMNS, *LABEL_COLUMNS)


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = inputs(spark, sf_dir).marked_reliable().where(F.col(SUB).isNotNull())
    return labels.label_distribution(trained, ATTRIBUTES)


def known_label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs(spark, sf_dir).marked_reliable()
    return labels.known_labels(rows, "tenant_name_label").select("id", "logo", "tenant_name_label")


def train_rows_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    tallied = inputs(spark, sf_dir).population(True).tallied.where(F.col(SUB).isNotNull())
    sums = [F.sum(F.col(f"{a}_agree") + F.col(f"{a}_disagree")).alias(a) for a in ATTRIBUTES]
    return (
        tallied.groupBy(forests.HELD_OUT).agg(*sums).unpivot(forests.HELD_OUT, list(ATTRIBUTES), "attribute", "n").where("n > 0")
    )


def exact_test_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known rows per attribute and side, where every attribute holds out exactly a fifth of its known rows."""
    given = inputs(spark, sf_dir)
    tallied = forests.exact_split_tally(given.marked_reliable(), KEYS, ATTRIBUTES, given.workspace)
    sums = [F.sum(F.col(f"{a}_agree") + F.col(f"{a}_disagree")).alias(a) for a in ATTRIBUTES]
    return tallied.groupBy(forests.HELD_OUT).agg(*sums).unpivot(forests.HELD_OUT, list(ATTRIBUTES), "attribute", "n").where("n > 0")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = forests.split(inputs(spark, sf_dir).marked_reliable())
    both = train.select(F.lit("train").alias("side"), "id").unionAll(test.select(F.lit("test"), "id"))
    return both.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("lowest"), F.max("id").alias("highest")
    )


def tally_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.roll_up(inputs(spark, sf_dir).population(False).tallied, KEYS)


def profile_submitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(inputs(spark, sf_dir).marked_rows(), SUB)


def profile_logo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(inputs(spark, sf_dir).marked_rows(), LOGO)


def profile_logo_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(inputs(spark, sf_dir).marked_rows(), LOGO, fill_count="observed")


def combine_submitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    return features.combine(given.all_rows(), given.profile(SUB, False), SUB, "inner")


def combine_logo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs(spark, sf_dir).combined()


def combine_logo_numeric_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs(spark, sf_dir).combined(numeric_logo=True)


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = features.add_rates(inputs(spark, sf_dir).combined(values=False))
    found, _ = model_columns(rated.columns)
    return rated.select("id", *KEYS, *found)


def features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    return features.build_features(given.all_rows(), workspace=given.workspace)


def features_reliable(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    return features.build_features(given.reliable_rows(), workspace=given.workspace)


def features_numeric_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    return features.build_features(given.all_rows(numeric_logo=True), workspace=given.workspace)


def submitter_vectors_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.submitter_vectors(inputs(spark, sf_dir).population(True).cells, INPUTS)


def submitter_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.submitter_support(inputs(spark, sf_dir).population(True).cells, INPUTS)


def submitter_first_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    return vectors.submitter_records(given.population(True).cells, INPUTS, readers.submitter_names(given.tables["person"]))


def submitter_report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The submitter report with logo rates in place of scores."""
    records = submitter_first_vector(spark, sf_dir)
    return reports.rank_submitters(records.withColumnsRenamed({f"{a}_logo_correct_rate": f"{a}_prob" for a in ATTRIBUTES}))


def version_report_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version report with submitter rates in place of scores."""
    given = inputs(spark, sf_dir)
    rows = given.labelled()  # first: labels are then read from these rows and not worked out on their own
    cells = given.population(False).cells
    cells = cells.withColumnsRenamed({f"{a}_submitter_correct_rate": f"{a}_prob" for a in ATTRIBUTES})
    return reports.version_rows(rows, cells)


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitter rate above one half as a prediction of the lease-term label."""
    given = inputs(spark, sf_dir)
    rated = labels.known_labels(features.build_features(given.marked_rows(), workspace=given.workspace), "lease_term_label")
    predicted = rated.withColumn("prediction", forests.predicted("lease_term_submitter_correct_rate"))
    return metrics.binary_metrics(predicted, "lease_term_label", "prediction")


def held_out_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics over held-out cells with logo rates in place of scores."""
    given = inputs(spark, sf_dir).population(True)
    stand_ins = given.cells.select(*KEYS, *[F.col(f"{a}_logo_correct_rate").alias(f"{a}_prob") for a in ATTRIBUTES])
    rows = joins.spread_join(given.tallied.where(forests.HELD_OUT), stand_ins, KEYS, null_safe=True)
    return metrics.held_out_metrics(rows, ATTRIBUTES)


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    path = given.workspace.path("pairs.parquet")
    sinks.write_parquet(pairs.build_pairs(given.tables), path)
    return spark.read.parquet(path)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    path, rows = given.workspace.path("pairs.csv"), pairs.build_pairs(given.tables)
    sinks.write_csv(rows, path, compression="gzip")
    return sinks.read_csv(spark, path, rows.schema)


def _in_range(*names: str) -> Column:
    """Whether all of these are numbers from 0 to 1."""
    return reduce(Column.__and__, [F.coalesce(F.col(c).cast("double").between(0, 1), F.lit(False)) for c in names])


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows per attribute, and whether accuracy and F1 are shares."""
    found = inputs(spark, sf_dir).fitted()[1]
    return found.select("attribute", "n", _in_range("accuracy").alias("accuracy_ok"), _in_range("f1").alias("f1_ok"))


def fixed_forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell's scores by two forests written out by hand."""
    given = inputs(spark, sf_dir)
    fixed = forests.from_nodes(spark, FIXED_TREES, INPUTS)
    return reports.score_cells(given.population(False).cells, fixed, given.workspace)


def submitter_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is in the submitter report, with what support, and whether its reliabilities hold together."""
    given = inputs(spark, sf_dir)
    names = readers.submitter_names(given.tables["person"])
    report = reports.submitter_report(given.population(True).cells, INPUTS, given.fitted()[0], names, given.workspace)
    general = reports.mean_of([f"{a}_reliability" for a in GENERAL_ATTRIBUTES])
    return report.select(
        "submitter_name",
        SUB,
        "n_support",
        _in_range(*[f"{a}_reliability" for a in ATTRIBUTES]).alias("reliabilities_ok"),
        (F.abs(F.col("general_reliability") - general) < 1e-9).alias("general_ok"),
    )


def version_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version report, with whether a score is a share in place of the score."""
    given = inputs(spark, sf_dir)
    labelled = given.labelled()  # first, as above
    scored = reports.score_cells(given.population(False).cells, given.fitted()[0], given.workspace)
    rows = reports.version_rows(labelled, given.workspace.stage(scored, "scored"))
    flags = [_in_range(f"{a}_prob").alias(f"{a}_prob_ok") for a in ATTRIBUTES]
    return rows.select("comp_data_id_version", "comp_data_id_master", *[f"{a}_version" for a in ATTRIBUTES], *flags)


def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells, and whether forests that were saved and loaded again score them as those in memory."""
    given = inputs(spark, sf_dir)
    path, fitted = given.workspace.path("models"), given.fitted()[0]
    forests.save_models(fitted, path)
    before = forests.score(given.population(False).cells, fitted, given.workspace)
    before = before.withColumnsRenamed({f"{a}_prob": f"{a}_before" for a in ATTRIBUTES})
    after = forests.score(before, forests.load_models(spark, path, ATTRIBUTES), given.workspace)
    same = reduce(Column.__and__, [F.col(f"{a}_before") == F.col(f"{a}_prob") for a in ATTRIBUTES])
    return after.select(*KEYS, "n", same.alias("same_scores"))


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job; its version report read back and typed."""
    given = inputs(spark, sf_dir)
    out = given.workspace.path("out")
    job.run(spark, given.tables, out, given.workspace)
    rows = sinks.read_csv(spark, f"{out}/version_reliability")
    ids = [F.col(c).cast("long").alias(c) for c in ("comp_data_id_version", "comp_data_id_master")]
    values = [F.col(f"{a}_version").cast("double").alias(f"{a}_version") for a in NUMERIC]
    days = [F.substring(f"{a}_version", 1, 10).alias(f"{a}_version") for a in DATES]
    flags = [_in_range(f"{a}_prob").alias(f"{a}_prob_ok") for a in ATTRIBUTES]
    return rows.select(*ids, "tenant_name_version", *values, *days, *flags)


def queries() -> dict[str, Query]:
    listed = [
        pairs_all,
        pairs_reliable,
        pairs_from_sql,
        progress_counts,
        links_per_master,
        reliable_masters,
        submitter_names,
        parse_date_text,
        labels_all,
        label_distribution,
        known_label_rows,
        train_rows_per_target,
        exact_test_share,
        split_counts,
        tally_cells,
        profile_submitter,
        profile_logo,
        profile_logo_observed,
        combine_submitter,
        combine_logo,
        combine_logo_numeric_key,
        rates,
        features_full,
        features_reliable,
        features_numeric_key,
        submitter_vectors_distinct,
        submitter_support,
        submitter_first_vector,
        submitter_report_order,
        version_report_projection,
        binary_metrics,
        held_out_metrics,
        parquet_round_trip,
        csv_round_trip,
        model_metrics,
        fixed_forest_scores,
        submitter_reliability,
        version_reliability,
        model_round_trip,
        end_to_end,
    ]
    label_queries = {
        "label_name_fuzzy": ["tenant_name"],
        "label_strict": STRICT,
        "label_band_size": ["transaction_size"],
        "label_band_term": ["lease_term"],
        "label_date_execution": ["execution_date"],
        "label_date_commencement": ["commencement_date"],
        "label_date_expiration": ["expiration_date"],
    }
    return {
        **{query.__name__: query for query in listed},
        **{name: _label_query(attributes) for name, attributes in label_queries.items()},
    }
