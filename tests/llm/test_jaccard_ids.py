"""Rows that share an id and differ in their text."""

import pytest

from envstream.llm import jaccard


def text(kind, change=None):
    words = [f"{kind}{i}" for i in range(60)]
    if change is not None:
        words[change] = "other"
    return " ".join(words)


@pytest.mark.parametrize("first", [1, 90, None])
@pytest.mark.parametrize("parts", [1, 5])
def test_every_text_of_an_id_brings_its_links(spark, first, parts):
    rows = [(first, text(k)) for k in "abcd"] + [
        (10 + i, text(k, 1)) for i, k in enumerate("abcd")] + [(50, text("e")), (51, text("e", 2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = {r.doc_id: r.component_id for r in jaccard.clusters(docs).collect()}
    root = None if first is None else min(first, 10)
    assert got == {first: root, **dict.fromkeys(range(10, 14), root), 50: 50, 51: 50}
