"""Limits of the text operators, to the last row."""

from collections import Counter

import pytest

from envstream.llm import mixing


@pytest.mark.parametrize("budget", [None, 7_000_000_000])
def test_no_document_comes_more_often_than_the_limit(spark, budget):
    rows = [(i, "rare", 10_000_019) for i in range(3)] + [
        (10 + i, "middle", 100_000_007) for i in range(3)] + [
        (100 + i, "big", 1_000_000_007) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long")
    found = mixing.weights(mixing.shares(docs, "source", "n"), budget=budget)
    assert all(r.n_tokens <= r.target <= 2 * r.n_tokens for r in found.collect())
    copies = Counter(r.doc_id for r in mixing.mixed(docs, tokens="n", budget=budget).collect())
    assert set(copies) == {r[0] for r in rows}
    assert max(copies.values()) == 2
