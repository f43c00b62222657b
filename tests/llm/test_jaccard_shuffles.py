"""What the Jaccard join shuffles, and that what it leaves out changes no result."""

import json
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from envstream.llm import jaccard

RUN = """
import sys
from envstream.llm import jaccard
from envstream.session import build_session
at = sys.argv[1]
spark = build_session("shuffles", 4, "local[4]", {
    "spark.ui.enabled": "false", "spark.checkpoint.dir": at + "/shared",
    "spark.sql.warehouse.dir": at + "/warehouse", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": "file://" + at + "/events", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false"})
jaccard.clusters(spark.read.json(at + "/docs.json")).write.parquet(at + "/out")
spark.stop()
"""


def changed(words, rng, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
    return words


def test_bytes_shuffled_for_each_shingle(tmp_path):
    rng, docs = random.Random(3), []
    for i in range(2400):  # a sixth are near copies
        new = i % 6 < 5 or i < 12
        words = [f"w{rng.randrange(10**9)}" for _ in range(300)] if new else changed(
            docs[i - 1 - i % 3], rng, 3)
        docs.append(words)
    rows = [{"doc_id": i, "text": " ".join(w)} for i, w in enumerate(docs)]
    (tmp_path / "docs.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], check=True, timeout=300,
                   cwd=Path(__file__).parents[2], capture_output=True)
    written = 0
    for line in next((tmp_path / "events").iterdir()).open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            written += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    hashes = sum(len(jaccard.shingles(r["text"])) for r in rows)
    assert 0 < written < 13.5 * hashes  # 11.5; it was 16.0


def root_of(texts):
    sets = {i: set(jaccard.shingles(t).tolist()) for i, t in texts.items()}
    root = {}
    for i in texts:
        todo, seen = [i], {i}
        while todo:
            at = sets[todo.pop()]
            more = [j for j, s in sets.items() if j not in seen and at and s
                    and 100 * len(at & s) >= 75 * len(at | s)]
            seen.update(more)
            todo += more
        root[i] = min(seen)
    return root


@pytest.mark.parametrize("dense", [64, 1])
@pytest.mark.parametrize("most", [jaccard.SMALL_IDS, 0])
def test_few_and_many_sets_have_the_same_links(spark, monkeypatch, most, dense):
    monkeypatch.setattr(jaccard, "SMALL_IDS", most)
    rng, texts = random.Random(9), {}
    for g in range(12):
        base = [f"g{rng.randrange(10**6)}" for _ in range(60)]
        chain = base
        for k in range(6):  # copies, near copies of one, and a chain of them
            chain = changed(chain, rng, 1)
            texts[len(texts)] = " ".join([base, changed(base, rng, 1), chain][k % 3])
    texts |= {100: "", 101: None, 102: "a b", 103: "A  b", 104: "a b"}
    rows = [(i, t) for i, t in texts.items()]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    got = jaccard.clusters(docs, dense=dense).collect()
    assert len(got) == len(rows) + 5
    assert {r.doc_id: r.component_id for r in got} == root_of(texts)


@pytest.mark.parametrize("most", [jaccard.SMALL_IDS, 0])
def test_every_set_is_posted_once(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "SMALL_IDS", most)
    rows = spark.createDataFrame(
        [(i % 9, bytes([i % 9, 7]), bytes([i % 9] * 5)) for i in range(20)] + [(50, b"x", b"xxxxx")],
        "node long, digest binary, prefix binary")
    again = rows.groupBy("node").count().where("count > 1").select("node")
    got = sorted((r.doc, bytes(r.prefix)) for r in jaccard._prefixes(rows, again).collect())
    assert got == [(i, bytes([i] * 5)) for i in range(9)] + [(50, b"xxxxx")]


def test_only_sets_that_a_step_needs_are_shuffled(spark, monkeypatch):
    sets = spark.createDataFrame([(i, b"s") for i in range(9)], "doc long, set binary")
    nodes = spark.createDataFrame([(3,), (5,), (3,), (77,)], "doc long")
    left = lambda: sorted(r.doc for r in jaccard._needed_sets(sets, nodes).collect())
    assert left() == [3, 5]
    monkeypatch.setattr(jaccard, "SMALL_IDS", 2)
    assert left() == list(range(9))


@pytest.mark.parametrize("most", [jaccard.MOST_ROWS, 2])
def test_repeated_shingles_come_rarest_first(monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST_ROWS", most)
    big = (1 << 40) - 1
    of = {1: [big, 7, 8], 2: [big, 7], 3: [big, 9], 4: [big, 7]}
    held = [{"fps": jaccard.packed(np.array(f, np.uint64) << np.uint64(24), 5),
             "docs": np.array([d]).tobytes(), "counts": np.array([len(f)], "<u4").tobytes()}
            for d, f in of.items()]
    rows = [r for b in jaccard._of_bucket(held) for r in b.to_pylist()]
    assert all(set(r) == {"doc", "met"} and 0 < r["met"] < 1 << 63 for r in rows)
    own = sorted(r["met"] for r in rows if r["doc"] == 1)
    assert [m & big for m in own] == [7, big]  # no other row has 8
    assert [m >> 40 for m in own] == [min(3, most), min(4, most)]
