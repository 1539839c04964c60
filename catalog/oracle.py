"""SQL that DuckDB runs on the driver's tables to check the registered queries."""

from __future__ import annotations

from catalog.sample import source_ctes
from recordtrust.registry import ATTRIBUTES, ENTITIES, GENERAL_ATTRIBUTES, rate_names

# The attributes that agree when they are equal.
STRICT = [
    "space_type_id", "starting_rent", "work_value", "free_months", "transaction_type_id",
    "rent_bumps_percent_bumps", "rent_bumps_dollar_bumps", "lease_type_id",
]
DATES = [a for a in ATTRIBUTES if a.endswith("_date")]
SUB, LOGO = (e.key for e in ENTITIES)
NUMERIC = [a for a in ATTRIBUTES if a != "tenant_name" and a not in DATES]
PAIR_COLUMNS = [
    "id", SUB, LOGO, "comp_data_id_version", "comp_data_id_master",
    *[f"{a}_{side}" for side in ("version", "master") for a in ATTRIBUTES],
]
LABEL_COLUMNS = [f"{a}_{kind}" for a in ATTRIBUTES for kind in ("filled", "label")]
RATES = rate_names(ATTRIBUTES)


def _attribute(a: str, side: str) -> str:
    home = {"tenant_name": f"{side}_tenant.name", "space_type_id": f"{side}_calc.space_type_id"}
    return home.get(a, f"{side}_data.{a}") + f" AS {a}_{side}"


def pairs_sql(logo: str = "logo") -> str:
    return f"""
        SELECT v.id, v.submitter_person_id, det.{logo} AS logo,
          v.comp_data_id AS comp_data_id_version, m.comp_data_id AS comp_data_id_master,
          {", ".join(_attribute(a, side) for side in ("version", "master") for a in ATTRIBUTES)},
          l.comp_master_id
        FROM comp_master_versions l
        JOIN comp_master m ON m.id = l.comp_master_id
        JOIN comp_data master_data ON master_data.id = m.comp_data_id
        JOIN comp_data_calculated_fields master_calc ON master_calc.comp_data_id = master_data.id
        LEFT JOIN tenant master_tenant ON master_tenant.id = master_data.tenant_id
        JOIN comp_version v ON v.id = l.comp_version_id
        JOIN comp_data version_data ON version_data.id = v.comp_data_id
        JOIN comp_data_calculated_fields version_calc ON version_calc.comp_data_id = version_data.id
        LEFT JOIN tenant version_tenant ON version_tenant.id = version_data.tenant_id
        LEFT JOIN comp_proposal prop ON prop.comp_version_id = v.id
        LEFT JOIN lease_tasks task ON task.batch_id = prop.comp_batch_id
        LEFT JOIN submissions sub ON sub.id = task.submission_id
        LEFT JOIN logo_detection_submission det ON det.id = sub.id"""


LINKS = "SELECT comp_master_id, count(*) AS links FROM comp_master_versions GROUP BY comp_master_id"
RELIABLE = f"comp_master_id IN (SELECT comp_master_id FROM ({LINKS}) WHERE links > 3)"


def _agrees(a: str) -> str:
    s, t = f"{a}_version", f"{a}_master"
    if a == "tenant_name":
        return f"{s} = {t} OR jaro_winkler_similarity({s}, {t}) > 0.9"
    if a == "transaction_size":
        return f"{s} >= {t} * CAST(0.95 AS DOUBLE) AND {s} <= {t} * CAST(1.05 AS DOUBLE)"
    if a == "lease_term":
        return f"{s} >= {t} * CAST(0.92 AS DOUBLE) AND {s} <= {t} * CAST(1.08 AS DOUBLE)"
    if a in DATES:
        return f"{s} BETWEEN {t} - INTERVAL 90 DAY AND {t} + INTERVAL 90 DAY"
    return f"{s} = {t}"


def _label(a: str) -> str:
    s, t = f"{a}_version", f"{a}_master"
    return (
        f"CAST(CASE WHEN {s} IS NULL THEN 0 ELSE 1 END AS INTEGER) AS {a}_filled, "
        f"CAST(CASE WHEN {s} IS NULL OR {t} IS NULL THEN -1 WHEN {_agrees(a)} THEN 1 ELSE 0 END AS INTEGER) AS {a}_label"
    )


LABELLED = f"SELECT *, {', '.join(_label(a) for a in ATTRIBUTES)} FROM pairs"


def profile_sql(key: str, observed: bool = False) -> str:
    stats = []
    for a in ATTRIBUTES:
        filled = f"sum({a}_filled)" if observed else "count(*)"
        stats += [
            f"CAST(sum(CASE WHEN {a}_label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS {a}_correct_{key}",
            f"CAST({filled} AS BIGINT) AS {a}_filled_{key}",
            f"count(*) AS {a}_total_{key}",
        ]
    return f"SELECT {key}, {', '.join(stats)} FROM labelled WHERE {key} IS NOT NULL GROUP BY {key}"


def _stats(key: str) -> list[str]:
    return [f"{a}_{s}_{key}" for a in ATTRIBUTES for s in ("correct", "filled", "total")]


def _filled(columns: list[str]) -> list[str]:
    """The zero fill of a combine: numbers only."""
    numbers = {f"{a}_{side}" for a in NUMERIC for side in ("version", "master")}
    return [f"COALESCE({c}, 0) AS {c}" if c in numbers else c for c in columns]


def _history(key: str) -> list[str]:
    out = []
    for a in ATTRIBUTES:
        out += [
            f"COALESCE({a}_correct_{key} - {a}_label, 0) AS {a}_correct_{key}_hist",
            f"COALESCE({a}_total_{key} - 1, 0) AS {a}_total_{key}_hist",
            f"COALESCE({a}_filled_{key} - {a}_filled, 0) AS {a}_filled_{key}_hist",
        ]
    return out


BASE_COLUMNS = _filled([*PAIR_COLUMNS, *LABEL_COLUMNS])
SUB_COLUMNS = [*_stats(SUB), *[f"{s}_hist" for s in _stats(SUB)]]
COMBINED_SUB = f"""
    SELECT {', '.join([*BASE_COLUMNS, *_stats(SUB), *_history(SUB)])}
    FROM labelled JOIN profile_sub USING ({SUB})"""


def combined_logo(numeric: bool = False) -> str:
    """The second combine; a numeric logo has been filled by the first one."""
    key = "COALESCE(c.logo, 0)" if numeric else "c.logo"
    columns = [c for c in [*PAIR_COLUMNS, *LABEL_COLUMNS, *SUB_COLUMNS] if c != LOGO]
    stats = [f"COALESCE({s}, 0) AS {s}" for s in _stats(LOGO)]
    return f"""
        SELECT {key} AS logo, {', '.join([*columns, *stats, *_history(LOGO)])}
        FROM combined_sub c LEFT JOIN (SELECT logo AS logo_key, * EXCLUDE (logo) FROM profile_logo) p
          ON p.logo_key = {key}"""


def _rate(a: str, key: str, part: str, whole: str) -> str:
    part, whole = f"{a}_{part}_{key}", f"{a}_{whole}_{key}"
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE CAST(0 AS DOUBLE) END"


RATE_COLUMNS = [
    f"{_rate(a, e.key, *pair)} AS {a}_{e.short}_{kind}_rate"
    for a in ATTRIBUTES
    for e in ENTITIES
    for kind, pair in (("correct", ("correct", "filled")), ("fill", ("filled", "total")))
]
FEATURES = f"SELECT *, {', '.join(RATE_COLUMNS)} FROM combined_logo"
VECTORS = f"SELECT DISTINCT {SUB}, {', '.join(RATES)} FROM features"
FIRST = f"""
    SELECT {SUB}, {', '.join(RATES)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {SUB} ORDER BY id, logo NULLS LAST) AS pos FROM features)
    WHERE pos = 1"""
SUPPORT = f"SELECT {SUB}, count(*) AS n_support FROM vectors GROUP BY {SUB}"
NAMES = "SELECT id, first_name || ' ' || last_name AS submitter_name FROM person"
RECORDS = f"""
    SELECT n.submitter_name, f.{SUB}, s.n_support, {', '.join(f'f.{r}' for r in RATES)}
    FROM first_vectors f JOIN support s ON s.{SUB} = f.{SUB} JOIN names n ON n.id = f.{SUB}"""


def bucket_sql(seed: int, buckets: int) -> str:
    return f"CAST('0x' || substr(md5(id || ':{seed}'), 1, 8) AS BIGINT) % {buckets}"


HELD_OUT = f"({bucket_sql(10, 1000)} < 200)"


def statement(body: str, *, only_reliable: bool = False, numeric_logo: bool = False) -> str:
    """The body behind all CTEs it may use; DuckDB leaves out those it does not."""
    pairs = pairs_sql("logo_num" if numeric_logo else "logo")
    if only_reliable:
        pairs = f"SELECT * FROM ({pairs}) WHERE {RELIABLE}"
    ctes = [
        *source_ctes(),
        ("pairs", pairs),
        ("labelled", LABELLED),
        ("profile_sub", profile_sql(SUB)),
        ("profile_logo", profile_sql(LOGO)),
        ("combined_sub", COMBINED_SUB),
        ("combined_logo", combined_logo(numeric_logo)),
        ("features", FEATURES),
        ("vectors", VECTORS),
        ("first_vectors", FIRST),
        ("support", SUPPORT),
        ("names", NAMES),
        ("records", RECORDS),
    ]
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n" + body


def labels_sql(attributes: list[str]) -> str:
    columns = [f"{a}_{kind}" for a in attributes for kind in ("version", "master", "filled", "label")]
    return statement(f"SELECT id, logo, {', '.join(columns)} FROM labelled")


def _tally() -> str:
    sums = []
    for a in ATTRIBUTES:
        sums += [
            f"count(*) FILTER (WHERE {a}_label = 1) AS {a}_agree",
            f"count(*) FILTER (WHERE {a}_label = 0) AS {a}_disagree",
        ]
    return f"SELECT {SUB}, {LOGO}, count(*) AS n, min(id) AS first_id, {', '.join(sums)} FROM labelled GROUP BY {SUB}, {LOGO}"


def _per_attribute(select: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT {select.replace('@', a)} FROM {source.replace('@', a)}" for a in ATTRIBUTES)


F1_PARTS = """
    SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
           count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn
    FROM ({rows})"""
METRICS = """
    SELECT {extra} tp + fp + fn + tn AS n,
      CASE WHEN tp + fp + fn + tn > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) ELSE 0.0::DOUBLE END AS accuracy,
      CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0::DOUBLE END AS f1
    FROM ({parts})"""


def _metrics(attribute: str, rate: str, where: str, extra: str = "") -> str:
    rows = (
        f"SELECT {attribute}_label AS y, CASE WHEN {attribute}_{rate} > 0.5 THEN 1 ELSE 0 END AS p "
        f"FROM features WHERE {attribute}_label <> -1 AND {where}"
    )
    return METRICS.format(extra=extra, parts=F1_PARTS.format(rows=rows))


# How dates are written, and what part of the time such a text keeps.
DATE_TEXTS = (
    ("%Y-%m-%d %H:%M:%S", "second", 0), ("%Y-%m-%d", "day", 0), ("%m/%d/%Y", "day", 0), ("%b %-d, %Y", "day", 0),
    ("%-m/%-d/%Y %-I:%M %p", "minute", 0), ("%B %-d, %Y", "day", 0), ("%Y/%m/%d %H:%M", "minute", 0), ("%Y%m%d", "day", 0),
    ("%Y%m%dT%H%M%S", "second", 0), ("%Y-%m-%dT%H:%M:%S+02:00", "second", 2), ("%A, %-d %B %Y", "day", 0),
    ("%-d-%b-%y %H:%M:%S GMT", "second", 0), ("%Y-%m-%dT%H:%M:%SZ", "second", 0),
)


def _parse_dates() -> str:
    shape = f"id % {len(DATE_TEXTS) + 1}"
    texts = " ".join(f"WHEN {shape} = {i} THEN strftime(execution_date_version, '{f}')" for i, (f, _, _) in enumerate(DATE_TEXTS))
    parsed = " ".join(
        f"WHEN {shape} = {i} THEN date_trunc('{part}', execution_date_version) - INTERVAL {east} HOUR" for i, (_, part, east) in enumerate(DATE_TEXTS)
    )
    return statement(
        f"""
        SELECT id, logo, txt AS execution_text, parsed AS execution_parsed,
          CAST(CASE WHEN parsed IS NULL OR execution_date_master IS NULL THEN -1
               WHEN parsed BETWEEN execution_date_master - INTERVAL 90 DAY AND execution_date_master + INTERVAL 90 DAY
               THEN 1 ELSE 0 END AS INTEGER) AS execution_label
        FROM (SELECT *, CASE {parsed} END AS parsed, CASE {texts} ELSE 'unread ' || id END AS txt FROM pairs)"""
    )


def _submitter_order() -> str:
    reliabilities = [f"{a}_logo_correct_rate AS {a}_reliability" for a in ATTRIBUTES]
    total = " + ".join(f"{a}_logo_correct_rate" for a in GENERAL_ATTRIBUTES)
    return statement(
        f"SELECT submitter_name, {SUB}, n_support, {', '.join(reliabilities)}, "
        f"({total}) / {len(GENERAL_ATTRIBUTES)} AS general_reliability FROM records",
        only_reliable=True,
    )


def _version_projection() -> str:
    columns = []
    for a in ATTRIBUTES:
        columns += [f"{a}_version", f"{a}_submitter_correct_rate AS {a}_prob"]
    return statement(f"SELECT comp_data_id_version, comp_data_id_master, {', '.join(columns)} FROM features")


def _flags() -> str:
    return ", ".join(f"true AS {a}_prob_ok" for a in ATTRIBUTES)


def _version_flags() -> str:
    values = ", ".join(f"{a}_version" for a in ATTRIBUTES)
    return statement(f"SELECT comp_data_id_version, comp_data_id_master, {values}, {_flags()} FROM features")


def _version_csv() -> str:
    """The version report as its CSV has it, where missing text and dates are 0 as well."""
    values = [f"CAST({a}_version AS DOUBLE) AS {a}_version" for a in NUMERIC]
    days = [f"COALESCE(strftime({a}_version, '%Y-%m-%d'), '0') AS {a}_version" for a in DATES]
    return statement(
        "SELECT comp_data_id_version, comp_data_id_master, COALESCE(tenant_name_version, '0') AS tenant_name_version, "
        f"{', '.join([*values, *days])}, {_flags()} FROM features"
    )


# Two small forests, a node being (input, threshold, left, right) or a leaf's share.
FIXED_TREES: dict[str, list[list[tuple]]] = {
    "tenant_name_label": [
        [
            ("tenant_name_submitter_correct_rate", 0.5, 1, 2), ("tenant_name_logo_correct_rate", 0.48, 3, 4),
            ("lease_term_submitter_correct_rate", 0.5, 5, 6), (0.125,), (0.25,), (0.5,), (0.875,),
        ],
        [
            ("tenant_name_logo_correct_rate", 0.5, 1, 2), (0.25,), ("execution_date_submitter_correct_rate", 0.45, 3, 4),
            (0.375,), ("tenant_name_submitter_correct_rate", 0.55, 5, 6), (0.625,), (1,),
        ],
        [(0.5,)],
    ],
    "lease_term_label": [
        [("lease_term_logo_fill_rate", 0.0, 1, 2), (0,), ("lease_term_submitter_correct_rate", 0.25, 3, 4), (0.125,), (0.75,)],
        [("lease_term_submitter_correct_rate", 0.75, 1, 2), ("lease_term_logo_correct_rate", 0.5, 3, 4), (1,), (0.375,), (0.5,)],
    ],
}


def _tree_sql(nodes: list[tuple], at: int = 0) -> str:
    if len(nodes[at]) == 1:
        return f"CAST({nodes[at][0]} AS DOUBLE)"
    name, threshold, left, right = nodes[at]
    return f"CASE WHEN {name} <= CAST({threshold} AS DOUBLE) THEN {_tree_sql(nodes, left)} ELSE {_tree_sql(nodes, right)} END"


def _fixed_scores() -> str:
    scores = []
    for label, trees in FIXED_TREES.items():
        total = " + ".join(f"({_tree_sql(nodes)})" for nodes in trees)
        scores.append(f"min(({total}) / {len(trees)}) AS {label.removesuffix('_label')}_prob")
    return f"SELECT {SUB}, {LOGO}, count(*) AS n, {', '.join(scores)} FROM features GROUP BY {SUB}, {LOGO}"


def oracle() -> dict[str, str]:
    pairs = ", ".join(PAIR_COLUMNS)
    held_out_rows = f"(SELECT *, {HELD_OUT} AS held_out FROM features) WHERE @_label <> -1"
    return {
        "pairs_all": statement(f"SELECT {pairs} FROM pairs"),
        "pairs_reliable": statement(f"SELECT {pairs} FROM pairs", only_reliable=True),
        "pairs_from_sql": statement(f"SELECT {pairs} FROM pairs", only_reliable=True),
        "progress_counts": statement(
            f"SELECT count(*) FILTER (WHERE {RELIABLE}) AS reliable_rows, count(*) AS all_rows FROM pairs"
        ),
        "links_per_master": statement(LINKS),
        "reliable_masters": statement(f"SELECT comp_master_id FROM ({LINKS}) WHERE links > 3"),
        "submitter_names": statement("SELECT * FROM names"),
        "label_name_fuzzy": labels_sql(["tenant_name"]),
        "label_strict": labels_sql(STRICT),
        "label_band_size": labels_sql(["transaction_size"]),
        "label_band_term": labels_sql(["lease_term"]),
        "label_date_execution": labels_sql(["execution_date"]),
        "label_date_commencement": labels_sql(["commencement_date"]),
        "label_date_expiration": labels_sql(["expiration_date"]),
        "parse_date_text": _parse_dates(),
        "labels_all": statement(f"SELECT {', '.join([*PAIR_COLUMNS, *LABEL_COLUMNS])} FROM labelled"),
        "label_distribution": statement(
            f"SELECT * FROM ({_per_attribute("'@' AS attribute, @_label AS label, count(*) AS n", 'features WHERE @_label <> -1 GROUP BY @_label')})",
            only_reliable=True,
        ),
        "known_label_rows": statement(
            "SELECT id, logo, tenant_name_label FROM labelled WHERE tenant_name_label <> -1", only_reliable=True
        ),
        "train_rows_per_target": statement(
            _per_attribute("'@' AS attribute, held_out, count(*) AS n", held_out_rows + " GROUP BY held_out"),
            only_reliable=True,
        ),
        "exact_test_share": statement(
            "SELECT attribute, held_out, n FROM ("
            + _per_attribute(
                "'@' AS attribute, unnest([true, false]) AS held_out, unnest([(count(*) + 4) // 5, count(*) - (count(*) + 4) // 5]) AS n",
                "labelled WHERE @_label <> -1",
            )
            + ") WHERE n > 0",
            only_reliable=True,
        ),
        "split_counts": statement(
            f"SELECT CASE WHEN {HELD_OUT} THEN 'test' ELSE 'train' END AS side, count(*) AS n, min(id) AS lowest, "
            "max(id) AS highest FROM labelled GROUP BY 1",
            only_reliable=True,
        ),
        "tally_cells": statement(_tally()),
        "profile_submitter": statement(profile_sql(SUB)),
        "profile_logo": statement(profile_sql(LOGO)),
        "profile_logo_observed": statement(profile_sql(LOGO, observed=True)),
        "combine_submitter": statement("SELECT * FROM combined_sub"),
        "combine_logo": statement("SELECT * FROM combined_logo"),
        "combine_logo_numeric_key": statement("SELECT * FROM combined_logo", numeric_logo=True),
        "rates": statement(f"SELECT id, {SUB}, logo, {', '.join(RATES)} FROM features"),
        "features_full": statement("SELECT * FROM features"),
        "features_reliable": statement("SELECT * FROM features", only_reliable=True),
        "features_numeric_key": statement("SELECT * FROM features", numeric_logo=True),
        "submitter_vectors_distinct": statement("SELECT * FROM vectors", only_reliable=True),
        "submitter_support": statement("SELECT * FROM support", only_reliable=True),
        "submitter_first_vector": statement("SELECT * FROM records", only_reliable=True),
        "submitter_report_order": _submitter_order(),
        "version_report_projection": _version_projection(),
        "binary_metrics": statement(_metrics("lease_term", "submitter_correct_rate", "true")),
        "held_out_metrics": statement(
            " UNION ALL ".join(_metrics(a, "logo_correct_rate", HELD_OUT, f"'{a}' AS attribute,") for a in ATTRIBUTES),
            only_reliable=True,
        ),
        "parquet_round_trip": statement(f"SELECT {pairs} FROM pairs"),
        "csv_round_trip": statement(f"SELECT {pairs} FROM pairs"),
        "model_metrics": statement(
            _per_attribute(
                "'@' AS attribute, count(*) AS n, true AS accuracy_ok, true AS f1_ok", held_out_rows + " AND held_out"
            ),
            only_reliable=True,
        ),
        "fixed_forest_scores": statement(_fixed_scores()),
        "submitter_reliability": statement(
            f"SELECT submitter_name, {SUB}, n_support, true AS reliabilities_ok, true AS general_ok FROM records",
            only_reliable=True,
        ),
        "version_reliability": _version_flags(),
        "model_round_trip": statement(
            f"SELECT {SUB}, {LOGO}, count(*) AS n, true AS same_scores FROM features GROUP BY {SUB}, {LOGO}"
        ),
        "end_to_end": _version_csv(),
    }
