"""Every stage of the pipeline against a plain version of it, on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from envstream.llm import toxicity
from envstream.session import shared_dir


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(input, output) of every stage, as dicts of columns by row."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        found[name] = (docs.collect(), out.collect(), docs.columns, out.columns)
        docs = out
    return found


def test_all_but_the_last_keep_the_columns(stages):
    for name, (_, _, before, after) in list(stages.items())[:-1]:
        assert before == after, name
    assert list(stages.values())[-1][3] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_toxic_documents_go(stages, spark, sf_dir):
    before, after, _, _ = stages["toxicity"]
    docs = spark.createDataFrame(before)
    model = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.toxicity for r in toxicity.scored(docs, model, keep=["doc_id"]).collect()}
    assert {r.doc_id for r in after} == {d for d, s in scores.items() if s < toxicity.THRESHOLD}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after, _, _ = stages["near copies"]
    sets = {r.doc_id: shingles(r.text) for r in before}
    root = {}
    for doc in sorted(sets):
        if doc in root:
            continue
        todo = [doc]
        root[doc] = doc
        while todo:
            at = todo.pop()
            for other in sets:
                both = len(sets[at] & sets[other])
                if other not in root and both and 4 * both >= 3 * len(sets[at] | sets[other]):
                    root[other] = doc
                    todo.append(other)
    assert sorted(r.doc_id for r in after) == sorted(d for d in sets if root[d] == d)


def test_documents_with_leaks_go(stages, spark, sf_dir):
    before, after, _, _ = stages["benchmark leaks"]

    def words(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        item = words(r.text)
        n = min(10, len(item))
        windows |= {tuple(item[i:i + n]) for i in range(len(item) - n + 1) if n}

    def leaks(text):
        doc = words(text)
        return any(tuple(doc[i:i + n]) in windows for n in {len(w) for w in windows}
                   for i in range(len(doc) - n + 1))

    assert sorted(r.doc_id for r in after) == sorted(
        r.doc_id for r in before if not leaks(r.text))


def test_every_document_is_in_the_mixture(stages):
    before, after, _, _ = stages["source mixing"]
    copies = Counter(r.doc_id for r in after)
    assert set(copies) == {r.doc_id for r in before} and max(copies.values()) <= 3
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)


def test_ids_of_every_copy_are_written(stages):
    before, after, _, _ = stages["token ids"]
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    at = 0
    for r in sorted(after, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_run_goes_through_all_stages(stages, spark, sf_dir):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(
        map(tuple, stages["token ids"][1]))
