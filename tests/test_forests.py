from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from recordtrust.operators.features import cell_profiles, cell_rates
from recordtrust.operators import forests
from recordtrust.operators.forests import (
    HELD_OUT,
    examples,
    from_spark,
    load_models,
    predicted,
    save_models,
    score,
    split,
    split_tally,
    train_all,
)
from recordtrust.operators.labels import known_labels, label_distribution
from recordtrust.operators.metrics import binary_metrics, held_out_metrics
from recordtrust.operators.reports import mean_of, rank_submitters, score_cells, submitter_report, version_rows
from recordtrust.registry import ATTRIBUTES, GENERAL_ATTRIBUTES, rate_names
from recordtrust.sources.workspace import Workspace

SUB, LOGO = "submitter_person_id", "logo"
KEYS = [SUB, LOGO]
ATTS = ["honest", "always", "never"]
INPUTS = rate_names(ATTS)


@pytest.fixture(scope="module")
def labelled(spark):
    """Submitters 1-8 are right nearly always or nearly never on ``honest``; the others have one class."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        sub = rng.randint(1, 8)
        good = rng.random() < (0.95 if sub % 2 else 0.1)
        known = rng.random() < 0.9
        rows.append((i, i + 10_000, i // 4, sub, rng.choice(["A", "B", None]), int(known), int(good) if known else -1, 1, 1, 1, 0))
    schema = (
        "id bigint, comp_data_id_version bigint, comp_data_id_master bigint, submitter_person_id bigint, logo string, "
        "honest_filled int, honest_label int, always_filled int, always_label int, never_filled int, never_label int"
    )
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", *[f"CAST(id AS double) AS {a}_version" for a in ATTS])


@pytest.fixture(scope="module")
def space(spark):
    with Workspace(spark) as workspace:
        yield workspace


@pytest.fixture(scope="module")
def tallied(labelled, space):
    return space.stage(split_tally(labelled, KEYS, ATTS), "tallied")


@pytest.fixture(scope="module")
def cells(tallied, space):
    return space.stage(cell_rates(cell_profiles(tallied), ATTS), "cells")


@pytest.fixture(scope="module")
def models(tallied, cells, space):
    return train_all(examples(tallied, cells, KEYS, INPUTS), ATTS, INPUTS, space, trees=8)


def test_split_keeps_ids_together_and_takes_a_fifth(spark):
    df = spark.range(20_000).selectExpr("id div 2 AS id")
    train, test = split(df)
    assert train.join(test, "id", "left_semi").count() == 0
    assert train.count() + test.count() == 20_000
    assert 3600 < test.count() < 4400
    assert split(df.repartition(7))[1].orderBy("id").collect() == test.orderBy("id").collect()
    assert split(df, seed=11)[1].orderBy("id").collect() != test.orderBy("id").collect()


def test_tally_holds_all_rows(labelled, tallied):
    sums = tallied.agg(F.sum("n"), F.sum("honest_agree"), F.sum("honest_disagree")).first()
    agree, disagree = (labelled.where(F.col("honest_label") == v).count() for v in (1, 0))
    assert tuple(sums) == (3000, agree, disagree)


@pytest.mark.parametrize("fraction", [0.2, 0.0, 1.0, 0.003])
def test_exact_share_per_target(spark, labelled, space, fraction):
    """Each target holds out the ceiling of its share of known rows, however the rows are dealt; nothing is lost."""
    counted = space.stage(forests.exact_split_tally(labelled, KEYS, ATTS, space, fraction), "exact")
    for a in ATTS:
        known = labelled.where(F.col(f"{a}_label") != -1).count()
        test = counted.where(HELD_OUT).agg(F.sum(F.col(f"{a}_agree") + F.col(f"{a}_disagree"))).first()[0] or 0
        every = counted.agg(F.sum(F.col(f"{a}_agree") + F.col(f"{a}_disagree"))).first()[0]
        assert (test, every) == (-(-known * round(1000 * fraction) // 1000), known)
    plain = cell_profiles(split_tally(labelled, KEYS, ATTS))
    found = cell_profiles(counted).select(plain.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_exact_share_of_equal_rows(spark, space):
    rows = spark.createDataFrame([(1, 1)] * 997 + [(1, -1)] * 50, "id long, x_label int").selectExpr("*", "1 AS k")
    counted = forests.exact_split_tally(rows, ["k"], ["x"], space).collect()
    assert {r.held_out: (r.n, r.x_agree) for r in counted} == {False: (1047, 797), True: (0, 200)}


def test_examples_are_the_training_side(labelled, tallied, cells):
    rows = examples(tallied, cells, KEYS, INPUTS)
    assert rows.agg(F.sum("n")).first()[0] == split(labelled)[0].count()
    assert rows.where(F.col(HELD_OUT)).count() == 0


def test_scores_tell_submitters_apart(cells, models, space):
    scored = score(cells, models, space)
    assert scored.columns == [*cells.columns, "honest_prob", "always_prob", "never_prob"]
    for r in scored.collect():
        assert 0 <= r.honest_prob <= 1
        assert (r.honest_prob > 0.5) == (r[SUB] % 2 == 1)


def test_one_class_gives_a_constant(cells, models, space):
    scored = score(cells, models, space)
    assert {(r.always_prob, r.never_prob) for r in scored.collect()} == {(1.0, 0.0)}


def test_held_out_metrics(labelled, tallied, cells, models, space):
    scored = score_cells(cells, models, space)
    rows = labelled.join(
        scored.withColumnsRenamed({SUB: "s", LOGO: "l"}), F.col(SUB).eqNullSafe(F.col("s")) & F.col(LOGO).eqNullSafe(F.col("l"))
    )
    _, test = split(known_labels(rows, "honest_label"))
    direct = binary_metrics(test.withColumn("p", predicted("honest_prob")), "honest_label", "p").first()
    test_cells = tallied.where(HELD_OUT).drop("n").join(
        scored.drop("n").withColumnsRenamed({SUB: "s", LOGO: "l"}),
        F.col(SUB).eqNullSafe(F.col("s")) & F.col(LOGO).eqNullSafe(F.col("l")),
    )
    by_cell = {r.attribute: r for r in held_out_metrics(test_cells, ATTS).collect()}
    assert (by_cell["honest"].n, by_cell["honest"].accuracy, by_cell["honest"].f1) == tuple(direct)
    assert direct.accuracy > 0.85
    assert (by_cell["always"].accuracy, by_cell["always"].f1) == (1.0, 1.0)
    assert (by_cell["never"].accuracy, by_cell["never"].f1) == (1.0, 0.0)  # no positive at all


def test_binary_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] + [(0, 0)] * 4, "y int, p int")
    assert tuple(binary_metrics(df, "y", "p").first()) == (10, 0.7, 6 / 9)
    assert tuple(binary_metrics(df.where("y > 5"), "y", "p").first()) == (0, 0.0, 0.0)


def test_saved_models_score_alike(spark, cells, models, space, tmp_path):
    save_models(models, str(tmp_path))
    again = load_models(spark, str(tmp_path), ATTS)
    order = [SUB, LOGO]
    assert score_cells(cells, again, space).orderBy(order).collect() == score_cells(cells, models, space).orderBy(order).collect()


def numbers(spark, n, seed=3):
    """Cells with three inputs and the counts of two targets."""
    rng = random.Random(seed)
    rows = [(i, rng.randrange(40) / 40, rng.random(), float(rng.randrange(3)), *[rng.choice([0, 0, 1, 5, 90]) for _ in range(4)]) for i in range(n)]
    return spark.createDataFrame(rows, "cell long, a double, b double, c double, x_disagree long, x_agree long, y_disagree long, y_agree long")


def nodes(found):
    return {(r.label, r.tree, r.part): tuple(r)[3:] for r in found.trees.collect()}


@pytest.mark.parametrize("depth", [None, 4])
def test_trees_do_not_depend_on_partitions_or_on_who_splits(spark, space, monkeypatch, depth):
    """Whole trees in a task, and trees whose upper nodes all tasks split, are the same trees."""
    rows = numbers(spark, 700)
    one = train_all(rows.coalesce(1), ["x", "y"], ["a", "b", "c"], space, trees=3, depth=depth)
    assert nodes(train_all(rows.repartition(5), ["x", "y"], ["a", "b", "c"], space, trees=3, depth=depth)) == nodes(one)
    alone = score(rows, one, space).orderBy("cell").collect()
    monkeypatch.setattr(forests, "NODE_CELLS", 60)
    monkeypatch.setattr(forests, "BLOCK", 50)
    monkeypatch.setattr(forests, "TOP_NODES", 30)
    split_up = train_all(rows.repartition(3), ["x", "y"], ["a", "b", "c"], space, trees=3, depth=depth)
    assert split_up.trees.where("part > 0").count() > 10
    assert score(rows, split_up, space).orderBy("cell").collect() == alone
    assert score(rows, one, space).orderBy("cell").collect() == alone


def test_target_that_needs_more_than_thirty_levels(spark, space):
    """Cells in a row with alternating classes: each cut of one input takes a few off an end."""
    rows = spark.createDataFrame([(i, 2.0**-i, 10**6 * (i % 2), 10**6 * (1 - i % 2)) for i in range(64)], "cell long, a double, x_disagree long, x_agree long")
    found = train_all(rows, ["x"], ["a"], space, trees=5)
    assert all(r.x_prob == 1 - r.cell % 2 for r in score(rows, found, space).collect())
    # Weights that halve from cell to cell: the best cut takes the heaviest cell off its end.
    weight = [2 ** (40 - i) for i in range(38)]
    chain = [(i, float(i), w * (i % 2), w * (1 - i % 2)) for i, w in enumerate(weight)]
    heavy = spark.createDataFrame(chain, "cell long, a double, x_disagree long, x_agree long")
    found = train_all(heavy, ["x"], ["a"], space, trees=2)
    assert min(_depth(r) for r in found.trees.collect()) > 30
    assert all(r.x_prob == 1 - r.cell % 2 for r in score(heavy, found, space).collect())


def _depth(tree, node=0):
    return 0 if tree.feature[node] < 0 else 1 + max(_depth(tree, tree.left[node]), _depth(tree, tree.right[node]))


def test_odd_training_sets(spark, space):
    rows = numbers(spark, 20)
    none = train_all(rows.limit(0), ["x", "y"], ["a", "b", "c"], space, trees=2)
    assert {(r.x_prob, r.y_prob) for r in score(rows, none, space).collect()} == {(0.0, 0.0)}
    zero = train_all(rows.withColumns({"x_agree": F.lit(0), "x_disagree": F.lit(0)}), ["x", "y"], ["a", "b", "c"], space, trees=2)
    assert {r.x_prob for r in score(rows, zero, space).collect()} == {0.0}
    assert score(rows.limit(0), zero, space).count() == 0
    missing = rows.withColumn("a", F.when(F.col("cell") > 9, F.col("a")))
    assert score(missing, train_all(missing, ["x", "y"], ["a", "b", "c"], space, trees=2), space).where("x_prob between 0 and 1").count() == 20


def test_spark_forest_as_a_table(spark, space, tmp_path):
    """The walk gives Spark's own probabilities, bit for bit but for the order of sums."""
    rows = numbers(spark, 400).selectExpr("*", "double(x_agree > x_disagree) AS label")
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=7, maxDepth=6, seed=5).fit(vectors)
    model.write().overwrite().save(f"{tmp_path}/rf")
    found = from_spark(spark, f"{tmp_path}/rf", "x_label", ["a", "b", "c"])
    mine = {r.cell: r.x_prob for r in score(rows, found, space).collect()}
    for r in model.transform(vectors).collect():
        assert mine[r.cell] == pytest.approx(r.probability[1], abs=1e-12)


WALK = """
WITH RECURSIVE vote AS (
    SELECT cell, tree, 0 AS node FROM rows, trees WHERE part = 0
    UNION ALL
    SELECT v.cell, v.tree, CASE WHEN list_count(list_filter(e.edges, lambda x: x < list_extract(r.v, t.feature[v.node + 1] + 1))) <= t.cut[v.node + 1]
                                THEN t.left[v.node + 1] ELSE t.right[v.node + 1] END
    FROM vote v JOIN trees t ON t.tree = v.tree JOIN (SELECT cell, [a, b, c] AS v FROM rows) r ON r.cell = v.cell
        JOIN edges e ON e.place = t.feature[v.node + 1]
    WHERE t.feature[v.node + 1] >= 0
)
SELECT cell, avg(t.agree[node + 1]) AS p FROM vote JOIN trees t USING (tree) WHERE t.feature[node + 1] < 0 GROUP BY cell
"""


def test_scores_by_sql(spark, space):
    """A small forest walked by recursive SQL over its node arrays, value by value."""
    rows = numbers(spark, 150)
    found = train_all(rows, ["x"], ["a", "b", "c"], space, trees=4)
    scored = {r.cell: r.x_prob for r in score(rows, found, space).collect()}
    with duckdb.connect() as db:
        db.register("rows", rows.toArrow())
        db.register("trees", found.trees.toArrow())
        db.register("edges", pa.table({"place": range(3), "edges": [e.tolist() for e in found.edges]}))
        assert {c: pytest.approx(p, abs=1e-12) for c, p in db.execute(WALK).fetchall()} == scored


def test_label_distribution(labelled):
    got = {(r.attribute, r.label): r.n for r in label_distribution(labelled, ATTS).collect()}
    expected = {("always", 1): 3000, ("never", 0): 3000}
    for v in (0, 1):
        expected["honest", v] = labelled.where(F.col("honest_label") == v).count()
    assert got == expected


def test_submitter_report(spark, cells, models, space):
    names = spark.createDataFrame([(i, f"N{i}") for i in range(1, 8)], "id bigint, submitter_name string")
    labels = [f"{a}_label" for a in ATTRIBUTES]
    honest = models.trees.where("label = 'honest_label'").withColumn("label", F.explode(F.array(*map(F.lit, labels))))
    report = submitter_report(cells, INPUTS, models._replace(trees=space.stage(honest, "honest"), labels=labels), names, space)
    assert report.columns == [
        "submitter_name", SUB, "n_support", *[f"{a}_reliability" for a in ATTRIBUTES], "general_reliability",
    ]
    rows = report.collect()
    assert len(rows) == 7
    assert [r.general_reliability for r in rows] == sorted((r.general_reliability for r in rows), reverse=True)


def test_submitter_order_and_mean(spark):
    columns = ", ".join(f"{a}_prob double" for a in ATTRIBUTES)
    probs = {"a": 0.25, "b": 0.5, "c": 0.5, "d": 0.5}
    support = {"a": 9, "b": 1, "c": 3, "d": 3}
    rows = [(n, i, support[n], *[p if a in GENERAL_ATTRIBUTES else 0.9 for a in ATTRIBUTES]) for i, (n, p) in enumerate(probs.items())]
    ranked = rank_submitters(spark.createDataFrame(rows, f"submitter_name string, {SUB} bigint, n_support bigint, {columns}"))
    assert [r.submitter_name for r in ranked.collect()] == ["c", "d", "b", "a"]
    assert [r.general_reliability for r in ranked.collect()] == [0.5, 0.5, 0.5, 0.25]
    assert spark.range(1).selectExpr("1.0D AS a", "2.0D AS b").select(mean_of(["a", "b"])).first()[0] == 1.5


@pytest.mark.parametrize("limits", [{}, {"taskRows": "20", "broadcastBytes": "0"}])
def test_version_rows(labelled, cells, models, space, settings, limits):
    settings(**limits)
    scored = score_cells(cells, models, space)
    rows = version_rows(labelled, scored, ATTS)
    assert rows.columns[:6] == ["comp_data_id_version", "comp_data_id_master", "honest_version", "honest_prob", "always_version", "always_prob"]
    got = rows.collect()
    assert len(got) == 3000
    order = [(r.comp_data_id_master, r.comp_data_id_version) for r in got]
    assert order == sorted(order)
    prob = {(r[SUB], r[LOGO]): r.honest_prob for r in scored.collect()}
    cell = {r.comp_data_id_version: (r[SUB], r[LOGO]) for r in labelled.collect()}
    assert all(r.honest_prob == prob[cell[r.comp_data_id_version]] for r in got)


def test_each_tree_has_a_task(spark):
    """No task waits for several trees while others have none."""
    blocks = spark.range(30).withColumnRenamed("id", "block")
    dealt = forests._by_tree(blocks, 40).groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("tree").alias("trees"), F.count("*").alias("n"))
    assert [(len(r.trees), r.n) for r in dealt.collect()] == [(1, 30)] * 40


def test_growth_shuffles_no_blocks(spark, space, monkeypatch):
    """A hundred trees used to get a shuffled copy of all blocks each."""
    shuffles, stage = {}, Workspace.stage

    def counted(self, df, name):
        shuffles[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange")
        return stage(self, df, name)

    monkeypatch.setattr(Workspace, "stage", counted)
    train_all(stage(space, numbers(spark, 300).coalesce(1), "numbers"), ["x", "y"], ["a", "b", "c"], space, trees=3)
    assert shuffles["forests"] == 0


def test_chunks_and_groups_of_trees_score_alike(spark, space, monkeypatch):
    rows = numbers(spark, 300).repartition(3)
    found = train_all(rows, ["x", "y"], ["a", "b", "c"], space, trees=7)
    whole = {r.cell: (r.x_prob, r.y_prob) for r in score(rows, found, space).collect()}
    monkeypatch.setattr(forests, "BLOCK", 20)
    monkeypatch.setattr(forests, "NODE_CELLS", 60)
    assert {r.cell: (r.x_prob, r.y_prob) for r in score(rows, found, space).collect()} == whole
    monkeypatch.setattr(forests, "SCORED_TREES", 2)
    for r in score(rows, found, space).collect():
        assert (r.x_prob, r.y_prob) == pytest.approx(whole[r.cell], abs=1e-12)


def test_models_saved_as_arrays_are_read(spark, space, tmp_path):
    rows = numbers(spark, 100)
    found = train_all(rows, ["x"], ["a", "b", "c"], space, trees=2)
    save_models(found, str(tmp_path))
    found.trees.drop("nodes").write.mode("overwrite").partitionBy("label").parquet(f"{tmp_path}/trees")
    again = load_models(spark, str(tmp_path), ["x"])
    assert score(rows, again, space).orderBy("cell").collect() == score(rows, found, space).orderBy("cell").collect()
