"""Accuracy and F1 of binary predictions, from one pass of conditional sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.functions.comparators import ratio
from recordtrust.operators.forests import predicted


def _accuracy(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    return ratio(tp + tn, tp + fp + fn + tn)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: rows, accuracy and F1 of class 1; F1 is 0 where it is undefined."""
    y, p = F.col(label), F.col(prediction)
    sums = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return sums.select(
        (tp + fp + fn + tn).alias("n"), _accuracy(tp, fp, fn, tn).alias("accuracy"), _f1(tp, fp, fn).alias("f1")
    )


def held_out_metrics(held_out: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Accuracy and F1 per attribute over held-out cells with scores; label counts weigh the cells."""
    sums, cells = [], []
    for a in attributes:
        hit = predicted(f"{a}_prob")
        agree, disagree = F.col(f"{a}_agree"), F.col(f"{a}_disagree")
        for name, part in (
            ("tp", agree * hit),
            ("fp", disagree * hit),
            ("fn", agree * (1 - hit)),
            ("tn", disagree * (1 - hit)),
        ):
            sums.append(F.coalesce(F.sum(part), F.lit(0)).alias(f"{a}_{name}"))
        tp, fp, fn, tn = (F.col(f"{a}_{name}") for name in ("tp", "fp", "fn", "tn"))
        cells.append(
            F.struct(
                F.lit(a).alias("attribute"),
                (tp + fp + fn + tn).alias("n"),
                _accuracy(tp, fp, fn, tn).alias("accuracy"),
                _f1(tp, fp, fn).alias("f1"),
            )
        )
    return held_out.agg(*sums).select(F.inline(F.array(*cells)))
