"""License notices in texts, found by voting on diagonals.

Notices are templates of words. Every rolling gram of words of a text is hashed
and joined to the places of the same gram in the templates; each meeting is a
vote for a diagonal (place in the text less place in the template) and counts
only if the words themselves are equal. Votes are summed per text, template and
diagonal. A diagonal that holds enough of its template is a span. The others are
merged with neighbouring diagonals, ``SHIFT`` words apart at most, so a notice
with words put in or left out is found as one span, and verified alike. Base
phrases are templates too; for them a span is the whole phrase, word by word.

Grams have ``GRAM`` words; a template of fewer words is one gram. The templates
are sent to the tasks in blocks of ``MOST_GRAMS`` grams at most; texts go
through once per block. Only votes are shuffled, never texts, and votes of equal
rows are merged before the shuffle.

Defined results: NULL and empty texts have no words and no spans; a text shorter
than every gram has none; rows with equal id (NULL included) and equal text are
worked off once and come back as often as they came; ids may repeat with other
texts. Other columns of the input are not read. An empty table gives no rows, an
empty list of notices no spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envstream.llm.common import table
from envstream.session import materialise

GRAM = 3
#: Neighbouring diagonals: at most so many words put in or left out at a place.
SHIFT = 5
#: Share of a template's words a span must hold, and of a span's words that must
#: be the template's.
HELD = 0.6
DENSE = 0.6
MOST_GRAMS = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases and labels of the base, as asked for.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Public license notices, in full or as they are commonly cited.
NOTICES = (
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software
        Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may
        not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under
        the License."""),
    ("mit", "Released under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of
        this software and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software."""),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def gram(self) -> int:
        return min(GRAM, len(self.words))

    def grams(self):
        n = self.gram
        return [(i, list(self.words[i:i + n])) for i in range(len(self.words) - n + 1)]


def templates(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    def words(text):
        normal = text.translate(str.maketrans(UPPER, LOWER))
        return tuple(w for w in re.split(_NO_WORD, normal) if w)

    made = [Template(label, words(text), base)
            for base, texts in ((True, phrases), (False, notices)) for label, text in texts]
    return [t for t in made if t.words]


def _words(text: Column) -> Column:
    # Of all signs beyond ASCII, only the Kelvin sign has a small letter in ASCII.
    # Without it, words in a-z are those that lowering A-Z alone gives.
    normal = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00f8")))
    return F.filter(F.split(normal, _NO_WORD), lambda w: w != "")


def _hash(values: Column, size):
    """Hash of the gram that begins at a place."""
    def of(first):
        return F.xxhash64(*(F.get(values, first + j) for j in range(size)))

    return of


def _starts(n_words, size):
    """Places at which a gram begins."""
    return F.when(n_words >= size, F.sequence(F.lit(0), n_words - size)).otherwise(
        F.array().cast("array<int>"))


def _grams(docs, doc, text, sizes) -> DataFrame:
    """One row per gram of a text, and a last one that stands for the row itself:
    doc, digest, n_words, words, size (0 in the last), place, hash."""
    rows = docs.select(
        F.col(doc).alias("doc"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
        _words(F.col(text)).alias("words"))
    rows = rows.select("*", F.size("words").alias("n_words"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("codes"))
    hashes = [F.transform(_starts(F.col("n_words"), k), _hash(F.col("codes"), k))
              for k in sizes]
    rows = rows.select("doc", "digest", "n_words", "words",
                       F.concat(*hashes, F.array(_row_hash())).alias("hashes"))
    rows = rows.select("doc", "digest", "n_words", "words",
                       # The outer form: the inner one makes Catalyst work everything out twice.
                       F.posexplode_outer("hashes").alias("slot", "hash"))
    size, place, before = F.lit(0), F.lit(0), F.lit(0)
    ends = []
    for k in sizes:  # grams of one size stand behind those of the size before
        end = before + F.greatest(F.col("n_words") - (k - 1), F.lit(0))
        ends.append((k, before, end))
        before = end
    for k, low, high in reversed(ends):
        inside = F.col("slot") < high
        size = F.when(inside, k).otherwise(size)
        place = F.when(inside, F.col("slot") - low).otherwise(place)
    return rows.select("*", size.alias("size"), place.alias("place"))


def _row_hash():
    return F.xxhash64(F.lit("row"))


def _blocks(chosen, most):
    rows = [(no, len(t.words), t.gram, i, gram)
            for no, t in enumerate(chosen) for i, gram in t.grams()]
    for low in range(0, max(1, len(rows)), most):
        yield rows[low:low + most]


def _votes(docs, doc, text, chosen, most) -> DataFrame:
    """(doc, digest, template, length, gram, shift, at); template -1 is the row itself,
    its shift the number of words."""
    spark = docs.sparkSession
    sizes = sorted({t.gram for t in chosen})
    grams = _grams(docs, doc, text, sizes)
    found = None
    for number, block in enumerate(_blocks(chosen, most)):
        places = spark.createDataFrame(
            block, "template int, length int, gram int, at int, gram_words array<string>")
        places = places.withColumn("hash", F.when(F.lit(False), F.lit(0)))
        for k in sizes:
            codes = F.transform("gram_words", lambda w: F.xxhash64(w))
            places = places.withColumn("hash", F.when(
                F.col("gram") == k, _hash(codes, k)(F.lit(0))).otherwise(F.col("hash")))
        if number == 0:
            itself = spark.range(1).select(
                F.lit(-1).alias("template"), F.lit(0).alias("length"), F.lit(0).alias("gram"),
                F.lit(0).alias("at"), F.array().cast("array<string>").alias("gram_words"),
                _row_hash().alias("hash"))
            places = places.unionByName(itself)
        # At most MOST_GRAMS rows of a few words each, whatever the data.
        # As a case, or Spark joins by the words and cuts them out at every place.
        equal = F.slice("words", F.col("place") + 1, F.col("size")) == F.col("gram_words")
        met = grams.join(F.broadcast(places), "hash").where(
            F.when(F.col("size") == F.col("gram"), equal))
        met = met.select("doc", "digest", "template", "length", "gram", "at",
                         F.when(F.col("size") == 0, F.col("n_words"))
                         .otherwise(F.col("place") - F.col("at")).alias("shift"))
        found = met if found is None else found.unionByName(met)
    return found


def _measured(held: DataFrame) -> DataFrame:
    """Adds ``covered``: how many of the template's words the votes hold."""
    words = F.flatten(F.transform("ats", lambda a: F.sequence(a, a + F.col("gram") - 1)))
    return held.withColumn("covered", F.size(F.array_distinct(words)))


def _verified():
    return ((F.col("covered") >= HELD * F.col("length"))
            & (F.col("covered") >= DENSE * (F.col("end") - F.col("begin"))))


def scanned(docs: DataFrame, doc="doc_id", text="text", chosen=None,
            most_grams=MOST_GRAMS) -> DataFrame:
    """One row per row of ``docs``: the id, n_words, spans (begin and end in words,
    label, base, covered, length of the template), by begin, end and template."""
    chosen = templates() if chosen is None else chosen
    key = ["doc", "digest"]
    sums = materialise(_votes(docs, doc, text, chosen, most_grams).groupBy(
        *key, "template", "length", "gram", "shift").agg(
            F.collect_set("at").alias("ats"), F.count("*").alias("copies")))
    diagonals = _measured(sums.where("template >= 0")).select(
        "*", (F.col("shift") + F.array_min("ats")).alias("begin"),
        (F.col("shift") + F.array_max("ats") + F.col("gram")).alias("end"))
    n_base = sum(t.base for t in chosen)  # they come first
    is_base = F.col("template") < n_base
    alone = F.when(is_base, F.col("covered") == F.col("length")).otherwise(_verified())
    in_order = Window.partitionBy(*key, "template").orderBy("shift")
    rest = diagonals.where(~is_base & ~alone).withColumn(
        "apart", F.coalesce(F.col("shift") - F.lag("shift").over(in_order) > SHIFT, F.lit(True)))
    rest = rest.withColumn("run", F.sum(F.col("apart").cast("int")).over(in_order))
    merged = _measured(rest.groupBy(*key, "template", "length", "gram", "run").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"),
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"))).where(_verified())
    columns = [*key, "template", "length", "covered", "begin", "end"]
    spans = diagonals.where(alone).select(*columns).unionByName(merged.select(*columns))
    labels = F.array(*(F.lit(t.label) for t in chosen)) if chosen else F.array(F.lit(None))
    span = F.struct("begin", "end", "template", F.get(labels, F.col("template")).alias("label"),
                    is_base.alias("base"), "covered", "length")
    parts = spans.select(*key, span.alias("span")).unionByName(
        sums.where("template = -1").select(
            *key, F.col("shift").alias("n_words"), "copies"), allowMissingColumns=True)
    rows = parts.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"), F.max("copies").alias("copies"),
        F.sort_array(F.collect_list("span")).alias("spans"))
    # Equal rows come back in two steps, so that no list of them grows long.
    many = rows.withColumn("lot", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr("(copies - 1) div 65536"))))
    left = F.least(F.col("copies") - F.col("lot") * 65536, F.lit(65536))
    many = many.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return many.select(F.col("doc").alias(doc), "n_words", "spans")


def _listed(labels):
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op11_license_scans(spark, sf_dir):
    rows = scanned(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)
    held = F.transform("spans", lambda s: (s.covered / s.length) * (s.covered / (s.covered + 3)))
    rows = rows.withColumn("base", base)
    starts = F.transform("base", lambda s: s.begin.cast("long"))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _listed(F.transform("base", lambda s: s.label)).alias("base_labels"),
        _listed(F.transform("spans", lambda s: s.label)).alias("labels"),
        F.coalesce(F.array_max(held), F.lit(0.0)).alias("score"))


def op11_sql() -> str:
    rows = ",\n  ".join(
        f"({no}, '{t.label}', {str(t.base).lower()}, {list(t.words)})"
        for no, t in enumerate(templates()))
    verified = f"covered >= {HELD} * length and covered >= {DENSE} * (e - b)"
    return f"""
with templates(template, label, base, words) as (values
  {rows}),
docs as (
  select row_number() over () as row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORD}') as words
  from documents),
sizes as (select distinct least({GRAM}, len(words)) as k from templates),
grams as (
  select row_no, k, i, array_to_string(words[i + 1:i + k], ' ') as gram
  from docs, sizes, unnest(range(0, len(words) - k + 1)) as t(i)),
known as (
  select template, base, len(words) as length, k, i as pos,
    array_to_string(words[i + 1:i + k], ' ') as gram
  from templates join sizes on k = least({GRAM}, len(words)),
    unnest(range(0, len(words) - k + 1)) as t(i)),
votes as (
  select row_no, template, base, length, k, i - pos as shift, pos
  from grams join known using (k, gram)),
diagonals as (
  select row_no, template, base, length, shift, count(distinct pos + j) as covered,
    min(pos) + shift as b, max(pos) + any_value(k) + shift as e
  from votes, unnest(range(0, k)) as t(j) group by row_no, template, base, length, shift),
judged as (
  select *, case when base then covered = length else {verified} end as alone from diagonals),
steps as (
  select *, coalesce(shift - lag(shift) over w > {SHIFT}, true) as apart
  from judged where not base and not alone
  window w as (partition by row_no, template order by shift)),
runs as (
  select *, sum(cast(apart as int)) over (partition by row_no, template order by shift) as run
  from steps),
merged as (
  select row_no, template, base, length, run, count(distinct pos + j) as covered,
    min(b) as b, max(e) as e
  from runs join votes using (row_no, template, shift, base, length),
    unnest(range(0, k)) as t(j) group by row_no, template, base, length, run),
spans as (
  select row_no, template, base, length, covered, b from judged where alone
  union all select row_no, template, base, length, covered, b from merged where {verified}),
summed as (
  select row_no, count(*) filter (where base) as n_base,
    min(b) filter (where base) as first_word, max(b) filter (where base) as last_word,
    string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels,
    max((covered / length) * (covered / (covered + 3))) as score
  from spans join (select template, label from templates) using (template) group by row_no)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base,
  cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, cast(0 as double)) as score
from docs left join summed using (row_no)"""
