"""The whole job: tables in; models, submitter report and version report out."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtrust.operators.features import cell_profiles, cell_rates
from recordtrust.operators.forests import HELD_OUT, Forests, exact_split_tally, examples, save_models, split_tally, train_all
from recordtrust.operators.joins import spread_join
from recordtrust.operators.metrics import held_out_metrics
from recordtrust.operators.pairs import MIN_LINKS, linked_pairs
from recordtrust.operators.reports import score_cells, submitter_report, version_rows
from recordtrust.registry import ATTRIBUTES, COMPARATORS, ENTITIES, Comparator, Entity, rate_names
from recordtrust.session import configured
from recordtrust.sources.readers import Tables, read_tables, submitter_names
from recordtrust.sources.sinks import write_csv
from recordtrust.sources.workspace import Workspace


RELIABLE = "reliable"


class Population(NamedTuple):
    """A set of labelled rows boiled down to label counts per cell and side of the split, and to cells with rates."""

    tallied: DataFrame
    cells: DataFrame


def label_pairs(tables: Tables, workspace: Workspace, comparators: Mapping[str, Comparator] = COMPARATORS) -> DataFrame:
    """All pairs with labels, staged once: the reliable ones are a filter on ``master_links``."""
    return workspace.stage(linked_pairs(tables, list(comparators), comparators), "labelled")


def populations(
    labelled: DataFrame,
    workspace: Workspace,
    attributes: Sequence[str] = ATTRIBUTES,
    entities: Sequence[Entity] = ENTITIES,
    exact: bool = False,
) -> tuple[Population, Population]:
    """The reliable rows and all rows, from one pass over the labels.

    Each population is profiled from its own rows: their counts are kept apart in the pass. Ids are held out as a
    whole; with ``exact`` every target holds out exactly a fifth of the known reliable rows instead.
    """
    keys = [e.key for e in entities]
    marked = labelled.withColumn(RELIABLE, F.col("master_links") > MIN_LINKS)
    if exact:
        parts = [exact_split_tally(marked.where(side), [*keys, RELIABLE], attributes, workspace) for side in (F.col(RELIABLE), ~F.col(RELIABLE))]
        tallied = workspace.stage(parts[0].unionByName(parts[1]), "tallied")
    else:
        tallied = workspace.stage(split_tally(marked, [*keys, RELIABLE], attributes), "tallied")

    def population(rows: DataFrame, name: str) -> Population:
        cells = cell_rates(cell_profiles(rows, entities), attributes, entities)
        return Population(rows, workspace.stage(cells, f"cells-{name}"))

    return population(tallied.where(RELIABLE), "reliable"), population(tallied, "all")


def fit(
    known: Population,
    workspace: Workspace,
    attributes: Sequence[str] = ATTRIBUTES,
    entities: Sequence[Entity] = ENTITIES,
    trees: int = 100,
    depth: int | None = None,
) -> tuple[Forests, DataFrame]:
    """Forests for all attributes, and their metrics on the held-out rows."""
    inputs, keys = rate_names(attributes, entities), [e.key for e in entities]
    rows = workspace.stage(examples(known.tallied, known.cells, keys, inputs), "examples")
    models = train_all(rows, attributes, inputs, workspace, trees, depth)
    scored = score_cells(known.cells, models, workspace, entities).drop("n")
    held_out = spread_join(known.tallied.where(HELD_OUT), scored, keys, null_safe=True)
    return models, held_out_metrics(held_out, attributes)


def run(
    spark: SparkSession,
    tables: Tables,
    out: str,
    workspace: Workspace | None = None,
    trees: int = 100,
    depth: int | None = None,
    comparators: Mapping[str, Comparator] = COMPARATORS,
    exact: bool = False,
) -> dict[str, int]:
    """Train on versions of well-linked masters, report on submitters and on all versions.

    ``trees`` and ``depth`` size the forests; without a depth their leaves are pure. ``comparators`` names the
    attributes and how each is compared; an attribute is a column
    of the records. ``exact`` holds out an exact share of each target's known rows instead of a share of the ids. Writes ``models``, ``metrics``, ``submitter_reliability`` and ``version_reliability`` under
    ``out`` and returns the row counts of both populations. Intermediate tables go to ``workspace``, or to one
    of the job's own that it deletes at the end.
    """
    if workspace is None:
        with Workspace(spark) as own:
            return run(spark, tables, out, own, trees, depth, comparators, exact)
    out = out.rstrip("/")
    attributes = list(comparators)
    inputs = rate_names(attributes, ENTITIES)

    every_row = label_pairs(tables, workspace, comparators)
    known, everyone = populations(every_row, workspace, attributes, exact=exact)
    models, metrics = fit(known, workspace, attributes, trees=trees, depth=depth)
    save_models(models, f"{out}/models")
    write_csv(metrics, f"{out}/metrics")

    names = submitter_names(tables["person"])
    write_csv(submitter_report(known.cells, inputs, models, names, workspace, attributes), f"{out}/submitter_reliability")
    scored = workspace.stage(score_cells(everyone.cells, models, workspace), "scored")
    write_csv(version_rows(every_row, scored, attributes), f"{out}/version_reliability", null_as_zero=True)
    return {name: part.tallied.agg(F.sum("n")).first()[0] for name, part in (("reliable", known), ("all", everyone))}


def main() -> None:
    parser = argparse.ArgumentParser(description="Score the reliability of submitted records.")
    parser.add_argument("--tables", required=True, help="folder with one <name>.parquet per relation")
    parser.add_argument("--out", required=True, help="folder for models and reports")
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--depth", type=int, help="levels of a tree, if not as many as it takes")
    parser.add_argument("--exact", action="store_true", help="hold out exactly a fifth of each target's known rows")
    args = parser.parse_args()
    spark = configured(SparkSession.builder.appName("recordtrust")).getOrCreate()
    counts = run(spark, read_tables(spark, args.tables), args.out, trees=args.trees, depth=args.depth, exact=args.exact)
    print(counts)


if __name__ == "__main__":
    main()
