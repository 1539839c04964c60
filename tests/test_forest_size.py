from __future__ import annotations

import pytest

from catalog import queries as catalog
from recordtrust.plans import job


class Trained(Exception):
    pass


def test_model_queries_fit_the_whole_forests(spark, monkeypatch):
    def train_all(rows, attributes, inputs, workspace, trees, depth, **_):
        raise Trained(trees, depth)

    monkeypatch.setattr(job, "train_all", train_all)
    monkeypatch.setattr(catalog, "_inputs", {})
    for query in (catalog.model_metrics, catalog.end_to_end):
        with pytest.raises(Trained) as seen:
            query(spark, "/root/testdata/sf0.001")
        assert seen.value.args == (100, None)
