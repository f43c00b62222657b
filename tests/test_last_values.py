"""Last values per key: ties, NULLs, repeated batches, compaction."""

from helpers import counted

from envstream.streaming.last_values import LastValues, last_rows

SHAPE = "name string, at int, v double, w string"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SHAPE)


def test_batches_are_merged_and_repeated_ones_replace_themselves(spark, tmp_path):
    first = rows(spark, ("a", 1, 1.0, "x"), ("a", 3, 1.0, "x"), ("a", 3, 2.0, None),
                 ("b", None, 5.0, "n"), (None, 1, 1.0, "k"))
    second = rows(spark, ("a", 2, 9.0, "late"), ("b", 1, 0.0, "y"))
    kept = LastValues(str(tmp_path / "last"), ("name",))
    for number, frame in ((0, first), (1, second), (1, second)):
        kept.write(last_rows(frame, ["name"], ["at"]), number)
    expected = [(None, 1, 1.0, "k"), ("a", 3, 2.0, None), ("b", 1, 0.0, "y")]
    assert counted(kept.read(spark)) == sorted(expected, key=repr)
    assert kept.changes(spark).count() == 5
    less = kept.compact(spark, str(tmp_path / "less"))
    assert less.changes(spark).count() == 3 and counted(less.read(spark)) == counted(kept.read(spark))
    less.write(last_rows(rows(spark, ("a", 4, 0.0, "z")), ["name"], ["at"]), 0)
    assert ("a", 4, 0.0, "z") in counted(less.read(spark))
