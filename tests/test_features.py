"""Profiles, combines and rates against a brute-force reading of their definition."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from recordtrust.operators.features import add_rates, build_features, cell_profiles, cell_rates, combine, combine_all
from recordtrust.operators.profile import profile, roll_up, tally
from recordtrust.operators.vectors import first_vector, submitter_records, submitter_support, submitter_vectors
from recordtrust.registry import ENTITIES, model_columns, rate_names, name_groups
from recordtrust.sources.workspace import Workspace

ATTS = ["size", "term"]
SUB, LOGO = "submitter_person_id", "logo"
LOGOS = {"string": ["A", "B", "C", None], "int": [0, 1, 2, None], "boolean": [False, True, None], "double": [0.0, 1.5, None, float("nan")]}


def make_rows(kind, n=120, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = {"id": i // 2, SUB: rng.choice([1, 2, 3, 4, None]), LOGO: rng.choice(LOGOS[kind])}
        for a in ATTS:
            row[f"{a}_version"] = rng.choice([None, 1.0, 2.0])
            row[f"{a}_filled"] = int(row[f"{a}_version"] is not None)
            row[f"{a}_label"] = rng.choice([-1, 0, 1]) if row[f"{a}_filled"] else -1
        rows.append(row)
    return rows


def frame(spark, kind, rows=None):
    columns = ", ".join(f"{a}_version double, {a}_filled int, {a}_label int" for a in ATTS)
    rows = make_rows(kind) if rows is None else rows
    names = ["id", SUB, LOGO, *[f"{a}_{c}" for a in ATTS for c in ("version", "filled", "label")]]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], f"id bigint, {SUB} bigint, {LOGO} {kind}, {columns}")


def missing(v):
    return v is None or v != v


def stats_by(rows, key, observed=False):
    out = {}
    for r in rows:
        if missing(r[key]):
            continue
        s = out.setdefault(r[key], {f"{a}_{k}": 0 for a in ATTS for k in ("correct", "total", "filled")})
        for a in ATTS:
            s[f"{a}_correct"] += r[f"{a}_label"] == 1
            s[f"{a}_total"] += 1
            s[f"{a}_filled"] += r[f"{a}_filled"] if observed else 1
    return out


def expected_features(rows, kind):
    """Inner join on the submitter, zero fill, left join on the logo, zero fill, rates."""
    subs, logos, out = stats_by(rows, SUB), stats_by(rows, LOGO), []
    for r in rows:
        if missing(r[SUB]):
            continue
        row = {k: (0.0 if missing(v) and k.endswith("_version") else v) for k, v in r.items()}
        if missing(row[LOGO]) and kind != "string":
            row[LOGO] = {"int": 0, "boolean": False, "double": 0.0}[kind]
        found = {SUB: subs[r[SUB]], LOGO: logos.get(row[LOGO])}
        for e in ENTITIES:
            for a in ATTS:
                correct, total, filled = ((found[e.key] or {}).get(f"{a}_{k}", 0) for k in ("correct", "total", "filled"))
                row[f"{a}_correct_{e.key}"], row[f"{a}_total_{e.key}"], row[f"{a}_filled_{e.key}"] = correct, total, filled
                hit = found[e.key] is not None
                row[f"{a}_correct_{e.key}_hist"] = correct - r[f"{a}_label"] if hit else 0
                row[f"{a}_total_{e.key}_hist"] = total - 1 if hit else 0
                row[f"{a}_filled_{e.key}_hist"] = filled - r[f"{a}_filled"] if hit else 0
                row[f"{a}_{e.short}_correct_rate"] = correct / filled if filled else 0.0
                row[f"{a}_{e.short}_fill_rate"] = filled / total if total else 0.0
        out.append(row)
    return out


def as_set(rows):
    return sorted((tuple(sorted(r.items())) for r in rows), key=repr)


def chained(df):
    once = combine(df, profile(df, SUB, ATTS), SUB, "inner", ATTS)
    return add_rates(combine(once, profile(df, LOGO, ATTS), LOGO, "left", ATTS), ATTS)


def at_once(df):
    return add_rates(combine_all(df, [profile(df, e.key, ATTS) for e in ENTITIES], ENTITIES, ATTS), ATTS)


@pytest.mark.parametrize("kind", ["string", "int", "boolean", "double"])
@pytest.mark.parametrize("limits", [{}, {"taskRows": "10", "broadcastBytes": "0"}])
@pytest.mark.parametrize("build", [chained, lambda df: build_features(df, ATTS), at_once], ids=["chained", "by_cell", "at_once"])
def test_features(spark, settings, kind, limits, build):
    settings(**limits)
    got = [r.asDict() for r in build(frame(spark, kind)).collect()]
    assert as_set(got) == as_set(expected_features(make_rows(kind), kind))


@pytest.mark.parametrize("kind", ["string", "int"])
def test_rows_are_not_shuffled_where_profiles_are_small(spark, settings, kind):
    """Cells take over 1,000 bytes here, both profiles together under 300."""
    settings(broadcastBytes="300")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build_features(frame(spark, kind), ATTS)
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert as_set([r.asDict() for r in df.collect()]) == as_set(expected_features(make_rows(kind), kind))


@pytest.mark.parametrize("kind", ["string", "int"])
def test_combined_rows_are_not_shuffled_where_distinct_statistics_are_small(spark, settings, kind):
    """Four submitters of 7 columns take 224 bytes, of 4 columns 128: totals and filled counts are one column."""
    settings(broadcastBytes="160")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df, space = frame(spark, kind), Workspace(spark)
        stats = [space.stage(profile(df, e.key, ATTS), "stats") for e in ENTITIES]
        both = combine_all(df, stats, ENTITIES, ATTS)
        assert "Exchange hashpartitioning" not in both._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    twice = combine(combine(df, stats[0], SUB, "inner", ATTS), stats[1], LOGO, "left", ATTS)
    assert both.columns == twice.columns and as_set(r.asDict() for r in both.collect()) == as_set(r.asDict() for r in twice.collect())


def test_statistics_that_differ_from_the_row_count_are_kept(spark):
    """Present values are counted, a label is null, one profile is empty."""
    df = frame(spark, "int").withColumn("term_label", F.expr("if(id % 7 = 0, null, term_label)"))
    stats = [profile(df, SUB, ATTS, "observed"), profile(df, LOGO, ATTS, "observed")]
    for logos in (stats[1], stats[1].where("false")):
        both = combine_all(df, [stats[0], logos], ENTITIES, ATTS)
        once = combine(df, stats[0], SUB, "inner", ATTS)
        twice = combine(once, logos, LOGO, "left", ATTS)
        assert as_set(r.asDict() for r in both.collect()) == as_set(r.asDict() for r in twice.collect())
    assert any(r[f"size_filled_{SUB}"] != r[f"size_total_{SUB}"] for r in both.collect())


@pytest.mark.parametrize("observed", [False, True])
@pytest.mark.parametrize("key,kind", [(SUB, "string"), (LOGO, "string"), (LOGO, "double")])
def test_profile(spark, key, kind, observed):
    got = profile(frame(spark, kind), key, ATTS, "observed" if observed else "rows")
    assert got.columns[0] == key and got.columns[1:] == sorted(got.columns[1:])
    expected = stats_by(make_rows(kind), key, observed)
    assert {r[key]: {f"{a}_{k}": r[f"{a}_{k}_{key}"] for a in ATTS for k in ("correct", "total", "filled")} for r in got.collect()} == expected


def test_profile_properties(spark):
    rows = profile(frame(spark, "string"), SUB, ATTS).collect()
    for r in rows:
        for a in ATTS:
            assert 0 <= r[f"{a}_correct_{SUB}"] <= r[f"{a}_total_{SUB}"] == r[f"{a}_filled_{SUB}"]


def test_unknown_fill_count_is_refused(spark):
    with pytest.raises(ValueError):
        profile(frame(spark, "string"), SUB, ATTS, "some")


def test_combine_refuses_other_shared_columns(spark):
    df = frame(spark, "string")
    with pytest.raises(ValueError):
        combine(df, profile(df, SUB, ATTS).withColumn("size_label", F.lit(1)), SUB, "inner", ATTS)


def test_partitioning_does_not_matter(spark):
    df = frame(spark, "string")
    one = as_set(r.asDict() for r in build_features(df.repartition(1), ATTS).collect())
    assert one == as_set(r.asDict() for r in build_features(df.repartition(13), ATTS).collect())


def test_observed_features_use_present_values(spark):
    df = build_features(frame(spark, "string"), ATTS, fill_count="observed")
    stats = stats_by(make_rows("string"), SUB, observed=True)
    for r in df.collect():
        s = stats[r[SUB]]
        assert r["size_submitter_fill_rate"] == s["size_filled"] / s["size_total"]


def cells_of(spark, rows):
    tallied = tally(frame(spark, "string", rows), [SUB, LOGO, "id"], ATTS)
    return cell_rates(cell_profiles(tallied), ATTS)


def test_roll_up_equals_direct_tally(spark):
    df = frame(spark, "string")
    fine = roll_up(tally(df, [SUB, LOGO, "id"], ATTS), [SUB, LOGO])
    direct = tally(df, [SUB, LOGO], ATTS)
    assert sorted(map(repr, fine.select(sorted(fine.columns)).collect())) == sorted(map(repr, direct.select(sorted(fine.columns)).collect()))


def test_support_equals_distinct_vectors_for_any_values(spark):
    """Nulls, their place, zeros of both signs, NaN and repeated rows count as grouping counts them."""
    odd = [None, 0.0, -0.0, 1.0, float("nan"), 0.5]
    rows = [(s, a, b) for s in (1, 2, None) for a in odd[: 3 if s == 2 else 6] for b in odd] * 2
    cells = spark.createDataFrame(rows, f"{SUB} long, a double, b double")
    want = submitter_vectors(cells, ["a", "b"]).groupBy(SUB).count()
    assert sorted(map(tuple, submitter_support(cells, ["a", "b"]).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = submitter_support(cells, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanged and not any("a#" in line or "b#" in line for line in exchanged)


def test_support_counts_distinct_vectors(spark):
    rows = make_rows("string")
    inputs = rate_names(ATTS)
    vectors = {(r[SUB], *[r[c] for c in inputs]) for r in expected_features(rows, "string")}
    got = submitter_support(cells_of(spark, rows), inputs)
    expected = {s: sum(v[0] == s for v in vectors) for s in {v[0] for v in vectors}}
    assert {r[SUB]: r.n_support for r in got.collect()} == expected


def test_logos_with_equal_rates_are_one_vector(spark):
    def row(i, logo):
        return {"id": i, SUB: 1, LOGO: logo, **{f"{a}_{c}": v for a in ATTS for c, v in (("version", 1.0), ("filled", 1), ("label", 1))}}

    cells = cells_of(spark, [row(1, "A"), row(2, "B"), row(3, None)])
    support = submitter_support(cells, rate_names(ATTS)).first()
    assert cells.count() == 3 and support.n_support == 2  # A and B agree in every rate


def test_first_vector_is_of_the_lowest_id_then_logo(spark):
    rows = make_rows("string")
    inputs = rate_names(ATTS)
    best = {}
    for r in expected_features(rows, "string"):
        rank = (r["id"], r[LOGO] is None, r[LOGO] or "")
        if r[SUB] not in best or rank < best[r[SUB]][0]:
            best[r[SUB]] = (rank, [r[c] for c in inputs])
    got = first_vector(cells_of(spark, rows), inputs)
    assert {r[SUB]: [r[c] for c in inputs] for r in got.collect()} == {s: v for s, (_, v) in best.items()}


def test_submitters_without_person_drop_and_double_persons_collapse(spark):
    names = spark.createDataFrame([(1, "Ann"), (2, "Bob"), (2, "Bob"), (9, "Zoe"), (3, None)], "id bigint, submitter_name string")
    got = submitter_records(cells_of(spark, make_rows("string")), rate_names(ATTS), names)
    assert sorted((r[SUB], r.submitter_name) for r in got.collect()) == [(1, "Ann"), (2, "Bob"), (3, None)]


def test_model_columns_by_suffix():
    columns = ["id", "a_rate", "b_count", "a_label", "rate_x"]
    assert model_columns(columns) == (["a_rate", "b_count"], ["a_label"])


def test_features_are_staged_in_the_checkpoint_folder(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path))
    build_features(frame(spark, "string"), ATTS, workspace=workspace)
    assert workspace.root.startswith(str(tmp_path)) and list(tmp_path.iterdir())


def test_name_groups():
    assert name_groups(["b", "a"]) == (["b_correct", "a_correct"], ["b_filled", "a_filled"], ["b_label", "a_label"])
    assert name_groups([]) == ([], [], [])
