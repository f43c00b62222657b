"""What the driver has to follow: no job again for each fold or partition, no shuffle
of few edges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from envstream.llm import components, toxicity


def written(monkeypatch, module):
    calls = []
    monkeypatch.setattr(module, "materialise", lambda df, f=module.materialise: (
        calls.append(df.columns), f(df))[1])
    return calls


def test_the_counts_of_all_models_come_from_one_pass(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, ("bad vile text " if i % 2 else "good fine words ") * 3) for i in range(200)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    calls = written(monkeypatch, toxicity)
    monkeypatch.setattr(type(docs), "toLocalIterator", lambda *a, **k: 1 / 0)  # a job a partition
    assert toxicity.fitted(docs, labels) is not None
    assert len(calls) == 2


def test_every_model_leaves_out_its_fold(spark):
    kinds = ", ".join(f"{p} long" for p in toxicity._PARTS)  # ordinary0, toxic0, ordinary1, ...
    grams = spark.createDataFrame([("abcde", 1, 2, 0, 0, 4, 8), ("bcdef", 0, 0, 3, 0, 0, 0)],
                                  "gram string, " + kinds)
    model = toxicity._models(grams, 1000)
    first, second = [[ord(c)] for c in "abcde"], [[ord(c)] for c in "bcdef"]

    def look(fold, gram):
        return model(fold).look("g", [np.array(c) for c in gram])[0].tolist()
    assert [look(k, first) for k in (-1, 0, 1, 2)] == [[10, 5], [8, 4], [10, 5], [2, 1]]
    assert [look(k, second) for k in (-1, 0, 1, 2)] == [[0, 3], [0, 3], [0, 0], [0, 3]]
    none = toxicity._models(grams.limit(0), 1000)(0)
    assert none.look("n", []).tolist() == [[0, 0]]


def test_few_edges_need_no_shuffle(spark, monkeypatch):
    parts = []
    monkeypatch.setattr(components, "materialise", lambda df, f=components.materialise: (
        parts.append(df.rdd.getNumPartitions()), f(df))[1])
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").repartition(7)
    found = {(r.node, r.root) for r in components.components(links).collect()}
    assert found == {(i, 0) for i in range(41)}
    assert len(parts) > 2 and set(parts[1:]) == {1}


@pytest.mark.parametrize("edges_a_task", [components.TASK_EDGES, 50])
def test_components_of_any_links(spark, monkeypatch, edges_a_task):
    monkeypatch.setattr(components, "TASK_EDGES", edges_a_task)
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    pairs += [(i, i + 1) for i in range(400, 460)] + [(None, 3), (900, None), (5, 5)]
    root = {n: n for p in pairs if None not in p and p[0] != p[1] for n in p}
    for _ in root:
        for a, b in pairs:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    links = spark.createDataFrame(pairs, "a long, b long").withColumn("c", F.lit(0))
    assert dict(components.components(links).select("node", "root").collect()) == root


def test_a_round_makes_one_row_an_edge_of_its_lowest_neighbours(spark):
    edges = spark.createDataFrame([(1, 5), (2, 5), (5, 8), (5, 9), (3, 9)], "a long, b long")
    hung = components._largest(edges)
    assert {tuple(r) for r in hung.collect()} == {(1, 5), (2, 5), (1, 8), (1, 9), (3, 9)}
    assert "Generate" not in hung._jdf.queryExecution().optimizedPlan().toString()
