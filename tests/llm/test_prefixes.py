"""The trie of conversations against a plain one, with odd rows, copies and long combs."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from envstream.llm import prefixes

SCHEMA = "conv_id long, turn int, role string, text string, a string, n string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "n", "i") for r in rows], SCHEMA)


def plain_conversations(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append(
                (turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain_nodes(convs):
    """Every prefix with its members, one dictionary entry each."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, convs_here in members.items():
        below = [p for p in members if p[:len(path)] == path]
        parents = {p[:-1] for p in below if p}
        ends = sorted(c for c in convs_here if len(convs[c]) == len(path))
        n_words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in below}
        out.append((
            min(convs_here), len(path), min(members[path[:-1]]) if path else None,
            len(convs_here), sum(1 for p in below if len(p) == len(path) + 1),
            sum(p not in parents for p in below),
            sum((len(members[p]) - 1) * n_words[p] for p in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def odd_rows():
    rng = random.Random(3)
    rows = [(None, 0, "user", "lost"), (50, None, None, None), (50, 1, "user", ""),
            (51, 2, "user", "x y"), (51, 2, "user", "x y"), (7, 0, "system", "only")]
    for conv in range(100, 140):  # a few words, so that many share turns
        rows += [(conv, t, "user" if t % 2 else "assistant", rng.choice(["a b", "c", "d e f"]))
                 for t in range(rng.randint(1, 5))]
    for conv in range(200, 212):  # copies, and one long comb with a branch at each turn
        rows += [(conv, t, "user", f"same {t}") for t in range(conv - 199)]
    return rows


@pytest.mark.parametrize("most", [prefixes.MOST_NODES, 0])
def test_nodes_of_odd_rows(spark, most):
    rows = odd_rows()
    convs = plain_rebuilt(plain_conversations(rows))
    assert any(not turns for turns in convs.values())
    made = prefixes.nodes(prefixes.rebuilt(prefixes.sequences(frame(spark, rows))), most)
    assert got(made) == plain_nodes(convs)


def test_empty_table(spark):
    assert prefixes.nodes(prefixes.rebuilt(prefixes.sequences(frame(spark, [])))).collect() == []


def test_exits_are_where_conversations_leave(spark):
    """Conversations of a second table against the trie of a first one."""
    rng = random.Random(5)

    def drawn(ids, longest):
        return [(c, t, "user", rng.choice("ab")) for c in ids for t in range(rng.randint(1, longest))]

    first, second = drawn(range(40), 12), drawn(range(100, 130), 17)
    known = prefixes.prefixes(prefixes.sequences(frame(spark, first)))
    strings = known.withColumn("key", F.struct(F.get("a", F.col("n")), F.get("b", F.col("n"))))
    trie = prefixes.build(strings.dropDuplicates(["key"]))
    asked = prefixes.prefixes(prefixes.sequences(frame(spark, second))).select(
        "conv_id", "n", "a", "b")
    exits = prefixes._exits(asked, trie, 17).collect()
    paths = {tuple(t[:d]) for t in plain_conversations(first).values() for d in range(len(t) + 1)}
    for r in exits:
        turns = plain_conversations(second)[r.conv_id]
        assert r.cut == max(d for d in range(len(turns) + 1) if tuple(turns[:d]) in paths)
        assert r.low <= r.cut and (r.end is None or r.cut < r.end)


def test_digest_of_many_lots(spark):
    ids = [*range(0, 30_000, 7), -5, 2**40]
    ends = spark.createDataFrame([("n", i) for i in ids], "id string, conv_id long")
    row, = prefixes.end_digests(ends).collect()
    assert row.ends_sha256 == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
