from __future__ import annotations

import random

import pytest

from recordtrust.sources.workspace import Workspace
from recordtrust.llm import toxicity


@pytest.mark.parametrize("share", [0.11, 0.45, 0.5, 0.9])
def test_any_share_of_toxic_documents(spark, share):
    rng = random.Random(11)
    plain, foul = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)], ["vexword", "grumble", "snarlish", "blightful", "wretchy"]
    rows = []
    for i in range(1_200):
        said = [[rng.choice(plain) for _ in range(8)] for _ in range(5)]
        toxic = rng.random() < share
        if toxic:
            rng.choice(said)[rng.randrange(8)] = rng.choice(foul)
        rows.append((i, ". ".join(" ".join(s) for s in said) + ".", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.classify(docs, docs.select("doc_id", "toxic"), Workspace(spark)).where("held_out").collect()
    truth = {i: t for i, _, t in rows}
    right = sum(r.predicted == truth[r.doc_id] for r in scored)
    print("SHARE", share, "RIGHT", right, "OF", len(scored), "PREDICTED TOXIC", sum(r.predicted for r in scored))
    assert right >= 0.95 * len(scored)
