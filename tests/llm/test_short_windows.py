"""Passages of few words, in shards that hold hardly more than one of them."""

import pytest

from envstream.llm import substring


@pytest.mark.parametrize("window", [5, 6, 7, 16])
def test_two_equal_short_texts(spark, window):
    text = " ".join(f"w{i}" for i in range(window))
    docs = spark.createDataFrame(
        [(1, text), (2, text), (3, "w0 w1 other")], "doc_id long, text string")
    rows = substring.deduplicated(docs, window=window).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: window, 3: 0}
