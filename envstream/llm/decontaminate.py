"""Benchmark decontamination with one Aho-Corasick automaton.

Items and documents are normalised alike: A-Z to a-z, and words of digits,
letters and everything beyond ASCII. The automaton's alphabet is the items'
words, its patterns are the windows of ``WINDOW`` consecutive item words; an
item of fewer words is one window. A text is scanned once, word by word. The
normalised bytes stand where the original ones do, so a hit word's place in
them is its place in the text.

Only the items are sent to the tasks, in blocks of at most ``BLOCK_BYTES``;
a larger benchmark is scanned block after block, each by an automaton of its
own, and the hits are merged.

Defined results: NULL and empty texts have no words and no hits; items without
words match nothing; repeated documents are scanned each, repeated items count
once; an empty table gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import cache_of, modest_batches, table

WINDOW = 10
BLOCK_BYTES = 8 << 20

_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: A-Z in small letters, other ASCII that is no word to a space, the rest as it is.
NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(data: bytes) -> list[bytes]:
    return data.translate(NORMAL).split()


class Items:
    """The automaton over the windows of items [(id, text)]."""

    def __init__(self, items, window=WINDOW):
        import ahocorasick

        self.ids, windows = [], {}
        self.codes = {}
        for item_id, text in items:
            words = tuple(self.codes.setdefault(w, len(self.codes) + 1)
                          for w in words_of((text or "").encode()))
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                windows.setdefault(words[i:i + n], set()).add(item_id)
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, owners in windows.items():
            self._automaton.add_word(words, (len(words), owners))
        self._shortest = min(map(len, windows), default=0)
        if windows:
            self._automaton.make_automaton()

    def scan(self, words):
        """(hit words as merged [from, to) pairs, ids of the items found)."""
        code = self.codes.get
        coded = tuple([code(w, 0) for w in words])
        if not self._shortest or len(coded) - coded.count(0) < self._shortest:
            return [], set()
        runs, found = [], set()
        for last, (n, owners) in self._automaton.iter(coded):
            found |= owners
            low = last + 1 - n
            while runs and low <= runs[-1][1] and low < runs[-1][0]:
                runs.pop()  # a longer window that ends here began before
            if runs and low <= runs[-1][1]:
                runs[-1][1] = last + 1
            else:
                runs.append([low, last + 1])
        return runs, found


def _automaton(name, shared, window):
    """Built once per worker and block of items."""
    built = cache_of("decontaminate")
    if name not in built:
        built.clear()
        built[name] = Items(shared.value, window)
    return built[name]


def _blocks(items: DataFrame, item_id, text, block_bytes):
    """The items in lists of at most ``block_bytes`` of text, one list at a time."""
    rows = items.select(item_id, text).where(F.col(text).isNotNull()).distinct()
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = size // block_bytes + 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64(item_id, text), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


def _merged(old, new):
    runs = []
    for low, high in sorted([*map(tuple, old), *map(tuple, new)]):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return runs


def contaminated(docs: DataFrame, items: DataFrame, text="text", item_id="item_id",
                 item_text="text", window=WINDOW, block_bytes=BLOCK_BYTES,
                 into="leak") -> DataFrame:
    """The rows with a struct ``into``: n_words, n_hit, items (sorted ids),
    spans (begin, end) of the hit stretches in characters of the text."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    leak = (f"struct<n_words:bigint,runs:array<array<int>>,items:array<{kind}>,"
            "spans:array<struct<begin:int,end:int>>>")
    rows = modest_batches(docs).select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.lit(None).cast(leak).alias("leak"))
    schema = rows.schema
    for block in _blocks(items, item_id, item_text, block_bytes):
        rows = rows.mapInArrow(
            _scanner(spark.sparkContext.broadcast(block), docs.columns.index(text), window), schema)
    hit = F.aggregate("leak.runs", F.lit(0), lambda n, r: n + r[1] - r[0])
    found = F.struct(
        F.col("leak.n_words").alias("n_words"), hit.cast("long").alias("n_hit"),
        F.col("leak.items").alias("items"), F.col("leak.spans").alias("spans"))
    return rows.select(*(F.col(f"row.`{c}`") for c in docs.columns if c != into),
                       found.alias(into))


def _scanner(shared, place, window):
    """The text is a field of the row, so it travels once each way."""
    name = uuid.uuid4().hex

    def scan(batches):
        automaton = _automaton(name, shared, window)
        for batch in batches:
            texts = batch.column(0).field(place).to_pylist()
            leaks = [
                _look(automaton, (text or "").encode(), old)
                for text, old in zip(texts, batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(leaks, batch.schema.field(1).type)],
                names=batch.schema.names)

    return scan


def _look(automaton, data, old):
    normal = data.translate(NORMAL)
    words = normal.split()
    runs, found = automaton.scan(words)
    if old:
        runs, found = _merged(old["runs"], runs), found | set(old["items"])
    spans = []
    if runs:
        places = [m.span() for m in _WORD.finditer(normal)]
        for low, high in runs:
            begin = len(data[:places[low][0]].decode())
            end = begin + len(data[places[low][0]:places[high - 1][1]].decode())
            spans.append({"begin": begin, "end": end})
    return {"n_words": len(words), "runs": [list(r) for r in runs],
            "items": sorted(found, key=str), "spans": spans}


def op6_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = contaminated(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("leak.items", lambda i: i.cast("string"))), ",")
    return rows.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"))


def op6_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
with items as (select item_id, {words} as words from benchmark),
windows as (
  select distinct item_id, least(len(words), {WINDOW}) as n,
    array_to_string(words[i:i + least(len(words), {WINDOW}) - 1], ' ') as w
  from items, unnest(range(1, len(words) - least(len(words), {WINDOW}) + 2)) as t(i)
  where len(words) > 0),
docs as (select row_number() over () as row_no, doc_id, {words} as words from documents),
places as (
  select row_no, i, n, array_to_string(words[i:i + n - 1], ' ') as w
  from docs, (select distinct n from windows) as sizes,
    unnest(range(1, len(words) - n + 2)) as t(i)),
found as (select row_no, i, n, item_id from places join windows using (n, w)),
hits as (
  select row_no, count(distinct k) as n_hit
  from found, unnest(range(i, i + n)) as t(k) group by row_no),
owners as (
  select row_no, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct row_no, cast(item_id as varchar) as name from found) group by row_no)
select doc_id, cast(len(words) as bigint) as n_words,
  cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (row_no) left join owners using (row_no)"""
