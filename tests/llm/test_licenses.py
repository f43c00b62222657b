"""License scans: notices with words put in or left out, odd rows, blocks of templates."""

from envstream.llm import licenses

SCHEMA = "doc_id long, text string, doc string, template string, copies int, words string"
APACHE = licenses.NOTICES[5][1]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "t", 7, "w") for r in rows], SCHEMA)


def found(df):
    return sorted((str(r.doc_id), r.n_words, [(s.begin, s.end, s.label, s.base) for s in r.spans])
                  for r in df.collect())


ROWS = [
    (1, "Released under the MIT License."), (2, None), (3, ""), (4, "  .,\n"), (5, "apache"),
    (6, "MIT license mit-LICENSE; cc by cc by"), (6, "MIT license mit-LICENSE; cc by cc by"),
    (6, "other text"), (None, "GNU general. Public license"), (None, "GNU general. Public license"),
    (7, "mit Kicense K mit license"), (8, "intro words " + APACHE + " more"),
    (9, APACHE.replace("governing", "that is governing").replace("You may obtain", "You obtain")),
    (10, "gnu general public"), (11, "word " * 50_000 + "mit license"),
]


def test_odd_rows_and_places(spark):
    rows = found(licenses.scanned(frame(spark, ROWS)))
    assert len(rows) == len(ROWS)
    by = {}
    for doc, n, spans in rows:
        by.setdefault(doc, []).append((n, spans))
    assert by["2"] == by["3"] == by["4"] == [(0, [])] and by["5"] == [(1, [])]
    assert by["1"] == [(5, [(0, 5, "mit", False), (3, 5, "mit", True)])]
    twice = (8, [(0, 2, "mit", True), (2, 4, "mit", True), (4, 6, "cc-by", True),
                 (6, 8, "cc-by", True)])
    assert sorted(by["6"], key=str) == sorted([(2, []), twice, twice], key=str)
    assert by["None"] == [(4, [(0, 4, "gpl", True)])] * 2
    assert by["7"] == [(5, [(3, 5, "mit", True)])] and by["10"] == [(3, [])]
    assert by["11"] == [(50_002, [(50_000, 50_002, "mit", True)])]
    assert licenses.scanned(frame(spark, [])).collect() == []


def test_neighbouring_diagonals_are_merged(spark):
    whole = len(licenses.templates((), ((("a", APACHE),)))[0].words)
    rows = {r.doc_id: r.spans for r in licenses.scanned(frame(spark, ROWS)).collect()}
    exact = [s for s in rows[8] if s.length == whole]
    assert [(s.begin, s.end, s.covered) for s in exact] == [(2, 2 + whole, whole)]
    # The longest stretch without a change holds enough by itself; the text with more
    # changes below needs its pieces put together.
    assert any(s.length == whole and s.label == "apache-2.0" for s in rows[9])
    words = APACHE.split()
    broken = " ".join(w if i % 12 else "inserted " + w for i, w in enumerate(words))
    spans = licenses.scanned(frame(spark, [(1, broken)])).first().spans
    long = [s for s in spans if s.length == whole]
    assert len(long) == 1 and long[0].begin <= 2 and long[0].end >= whole
    # Every third word another: no gram is left, nothing is found.
    torn = " ".join("x" if i % 3 == 0 else w for i, w in enumerate(words))
    assert [s for s in licenses.scanned(frame(spark, [(1, torn)])).first().spans
            if not s.base] == []


def test_blocks_of_templates_give_the_same(spark):
    docs = frame(spark, ROWS)
    assert found(licenses.scanned(docs, most_grams=20)) == found(licenses.scanned(docs))
    assert [r.spans for r in licenses.scanned(docs, chosen=[]).collect()] == [[]] * len(ROWS)
