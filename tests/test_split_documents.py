"""One document read in many splits, against the same document read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators.catalogue import name_list
from envstream.sinks import outputs
from envstream.sources import files, split_documents

ODD = ['plain', 'a}b', '{', '}}{{', 'quote " in', 'back \\', '\\" both }', 'comma, {"x": 1}', 'ä}ö', '']


def air_document(n):
    rng = random.Random(n)
    return {f"{ODD[i % len(ODD)]}#{i}": {
        "coord": {"lon": float(i), "lat": -float(i)},
        "list": [{"dt": rng.randint(1, 10**9), "main": {"aqi": rng.randint(1, 5)},
                  "components": {"co": rng.random(), "note": rng.choice(ODD)}}
                 for _ in range(rng.randint(0, 4))],
    } for i in range(n)}


def written(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "one.json").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("indent", [None, 2])
def test_object_in_splits_equals_object_read_whole(spark, tmp_path, indent):
    path = written(tmp_path, "map", json.dumps(air_document(60), indent=indent, ensure_ascii=False))
    whole = files.scan_raw_air(spark, path).drop("location_no")
    assert whole.count() > 50
    for size in (None, 37, 500):
        made = split_documents.scan_raw_air_document(spark, path, size)
        assert sorted(map(repr, made.drop("location_no").collect())) == sorted(
            map(repr, whole.collect()))
    cut = split_documents.fragments(spark, path, "}", 500)
    assert cut.select("split").distinct().count() > 4
    numbers = {r.location_name: r.location_no for r in made.collect()}
    names = list(air_document(60))
    assert all(names[number] == name for name, number in numbers.items())


@pytest.mark.parametrize("text, n", [
    ("", 0), ("{}", 0), ("  \n", 0), ("{ }\n", 0), ('{"a": {"list": []}}', 0),
    ('{"a": {"list": [{"dt": 1}]}, "b": {"list": [{"dt": 2}, {"dt": 3}', 1)])
def test_odd_objects(spark, tmp_path, text, n):
    path = written(tmp_path, "odd", text)
    rows = split_documents.scan_raw_weather_document(spark, path, 5).collect()
    assert len(rows) == n


def test_array_in_splits(spark, tmp_path):
    rows = [{"id": i, "name": ODD[i % len(ODD)], "country": "X",
             "coord": {"lon": 1.0, "lat": float(i)}} for i in range(200)]
    path = written(tmp_path, "array", json.dumps(rows, ensure_ascii=False))
    for size in (50, None):
        got = split_documents.scan_array_document(spark, path, S.CATALOGUE_RECORD, size)
        assert [(r["index"], r.id, r.name, r.coord.lat) for r in got.orderBy("index").collect()] == [
            (i, i, r["name"], float(i)) for i, r in enumerate(rows)]
    for text in ("[]", "", "[ ]"):
        path = written(tmp_path, f"empty{len(text)}", text)
        assert split_documents.scan_array_document(spark, path, S.CATALOGUE_RECORD).collect() == []


@pytest.mark.parametrize("text", [
    '"a", "b", "c"', '"a,b", "c", "d,  e"', 'a,"" b, c', '"one"', ', , x', ' "a", "b"',
    '"de n"Hug", "long, long, name", "x,y,z"', '"a", "b",,c'])
def test_name_line_in_splits(spark, tmp_path, text):
    path = written(tmp_path, "names", text)
    expected = [tuple(r) for r in name_list(
        spark.createDataFrame([(text,)], "value string")).orderBy("item_no").collect()]
    for size in (1, 4, None):
        made = split_documents.scan_name_line(spark, path, size).orderBy("item_no").collect()
        assert [tuple(r) for r in made] == expected


@pytest.mark.parametrize("ids", [[(i * 7919) % 5000 for i in range(5000)] + [0, 0], []])
def test_document_in_order_from_many_sorted_parts(spark, tmp_path, ids):
    """Rows of one place stand side by side, and only the first row opens."""
    rows = spark.createDataFrame([(i, f"[{i}]") for i in ids], "id long, value string")
    path = tmp_path / "document"
    outputs.write_document(rows.repartition(8), str(path), ["id"], "<", ">")
    (file,) = path.glob("*.txt")
    lines = [("," if n else "<") + f"[{i}]" for n, i in enumerate(sorted(ids))]
    assert file.read_text().split("\n") == (lines + [">", ""] if ids else ["<>", ""])


@pytest.mark.parametrize("n, parts", [(1, 1), (1000, 9)])
def test_partitions_follow_the_document(spark, n, parts):
    rows = spark.range(n).selectExpr("'f' as file", "id % 40 as split", "id as place",
                                     "'0123456789' as text")
    found = split_documents.parts_for(rows, 1200)
    assert found == parts
    spread = split_documents.added_before(rows, F.lit(1), "before", found)
    assert {(r["split"], r["place"]): r["before"] for r in spread.collect()} == {
        (i % 40, i): rank for rank, i in enumerate(sorted(range(n), key=lambda i: (i % 40, i)))}
    dealt = split_documents.dealt(rows, found, "file", "split")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found <= usual or dealt.rdd.getNumPartitions() == found
