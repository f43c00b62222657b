import numpy as np
import pyarrow as pa

from envstream.llm import substring

KINDS = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
NAMES = ["shard", "passage", "doc", "row", "start", "n"]


def passages(*rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names=NAMES)


def test_whole_passages_pass_by_the_search(monkeypatch):
    held = []
    monkeypatch.setattr(substring, "_of_shard", lambda rows, window: held.extend(rows) or ())
    batch = passages((0, None, 7, 70, 3, 22), (0, b"a b", 1, 10, 0, 2), (1, None, 8, 80, 0, 25))
    gone = pa.Table.from_batches(substring._searched(20)([batch])).to_pylist()
    assert [tuple(g.values()) for g in gone] == [(7, 70, 3, 25), (8, 80, 0, 25)]
    assert [p[0] for p in held] == [b"a b"]


def test_the_later_of_equal_windows_is_found_across_batches():
    text = b" ".join(b"w%d" % i for i in range(21))
    batches = [passages((0, text, 2, 20, 5, 21)), passages((0, b"x " + text, 1, 10, 0, 22)),
               passages((1, text, 3, 30, 0, 21))]
    gone = pa.Table.from_batches(substring._searched(20)(batches)).to_pylist()
    assert [tuple(g.values()) for g in gone] == [(2, 20, 5, 26)]


def test_spans_of_a_slice_and_null_spans():
    words = [b"v%d" % i for i in range(8)]
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    whole = pa.RecordBatch.from_arrays([
        pa.array([1, 2, 3, 4], pa.int64()),
        pa.array([b" ".join(words).decode()] * 3 + [None]),
        pa.array([[{"begin": 0, "end": 8}], None,
                  [{"begin": 1, "end": 3}, {"begin": 1, "end": 2}, {"begin": 6, "end": 8}], []],
                 span)], names=["doc", "text", "spans"])
    rows = [r for b in substring._kept_rows(True)([whole, whole.slice(1)]) for r in b.to_pylist()]
    assert [(r["n_words"], r["n_removed"]) for r in rows] == [
        (8, 8), (8, 0), (8, 4), (0, 0), (8, 0), (8, 4), (0, 0)]
    assert rows[5]["kept"] == "v0 v3 v4 v5"


def test_hashes_are_those_of_each_word():
    import xxhash

    words = [b"w%d" % (i % 30) for i in range(40)]
    gram, places = substring.anchors(words)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    want = np.zeros(37, np.uint64)
    for j in range(4):
        want = substring.mix(want + h[j:37 + j] + np.uint64(j + 1))
    assert (gram == want).all() and len(places) == 21
