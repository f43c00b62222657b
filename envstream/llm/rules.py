"""Quality rules: a threshold table that becomes one projection.

Each rule bounds a ratio of counts that are worked out per text by built-in
functions. A row's columns are kept; the counts, one flag per rule and the
verdict are put into one struct, so columns of the input never clash.

Defined results: a NULL or empty text has no words and fails the base rules;
repeated rows are judged alike, each by itself; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envstream.llm.common import let, table, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"

STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as",
    "be", "at", "by", "this", "from", "or", "an", "are", "not",
    # French
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "que", "qui", "dans", "pour",
    "sur", "pas", "au", "avec", "en",
    # German
    "der", "die", "das", "und", "ist", "von", "mit", "den", "ein", "eine", "zu", "nicht", "auf",
    "für", "im", "sich", "dem",
    # Spanish
    "el", "los", "las", "y", "se", "del", "por", "con", "no", "su", "para", "al", "lo", "como",
)


@dataclass(frozen=True)
class Rule:
    """``low <= num / den <= high``, as integers: bounds are per 1000."""

    name: str
    num: str
    den: str
    low: int | None = None
    high: int | None = None

    def holds(self, counts: Column) -> Column:
        value, per = counts[self.num] * 1000, counts[self.den]
        tests = [F.lit(True)]
        if self.low is not None:
            tests.append(value >= per * self.low)
        if self.high is not None:
            tests.append(value <= per * self.high)
        return tests[0] if len(tests) == 1 else _all(tests[1:])

    def sql(self) -> str:
        parts = []
        if self.low is not None:
            parts.append(f"{self.num} * 1000 >= {self.den} * {self.low}")
        if self.high is not None:
            parts.append(f"{self.num} * 1000 <= {self.den} * {self.high}")
        return " and ".join(parts) or "true"


def _all(tests):
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


#: What fails a text whatever the rules say.
BASE = (
    Rule("enough_words", "n_words", "one", low=20_000),
    Rule("few_repeats", "n_repeat_words", "n_words", high=300),
)

RULES = (
    Rule("word_length", "word_chars", "n_words", low=2000, high=20_000),
    Rule("symbols", "n_symbols", "n_words", high=250),
    Rule("shouting", "n_exclaimed", "n_words", high=300),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=500),
)


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Number of words covered by windows of ``size`` words that occur twice or more.

    Hashes of the windows tell whether any occurs twice at all. Only then are
    the windows themselves sorted, so the count is exact.
    """

    def starts(words):
        return F.sequence(F.lit(1), F.size(words) - (size - 1))

    def hashes(words):
        return F.transform(starts(words), lambda i: F.xxhash64(F.slice(words, i, size)))

    def covered(words):
        windows = F.array_sort(F.transform(starts(words), lambda i: F.struct(
            F.array_join(F.slice(words, i, size), " ").alias("w"), i.alias("i"))))

        def same(s, at):
            return F.coalesce(F.get(s, at)["w"], F.lit(""))

        repeated = let(windows, lambda s: F.filter(s, lambda x, j: (
            (x["w"] == F.when(j > 0, same(s, j - 1)).otherwise("")) | (x["w"] == same(s, j + 1)))))
        begins = F.array_sort(F.transform(repeated, lambda x: x["i"]))
        return let(begins, lambda b: F.aggregate(
            F.transform(b, lambda i, j: F.least(
                F.lit(size), F.coalesce(F.get(b, j + 1) - i, F.lit(size)))),
            F.lit(0), lambda total, n: total + n))

    doubled = let(hashes(words), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when((F.size(words) > size) & doubled, covered(words)).otherwise(0)


def _counts(text: Column, stop_words) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words):
        stops = F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words)))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            stops.cast("long").alias("n_stop_words"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
            F.lit(1).cast("long").alias("one"),
            _n_chars(text, SYMBOLS).alias("n_symbols"),
            _n_chars(text, "!").alias("n_exclaimed"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    return let(words_of(text), of_words)


def _n_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def judged(df: DataFrame, text="text", rules=RULES, base=BASE, stop_words=STOP_WORDS,
           into="quality") -> DataFrame:
    """The rows with a struct ``into``: counts, base_failed, failed (names), kept."""
    counts = _counts(F.coalesce(F.col(text), F.lit("")), stop_words)

    def verdict(c):
        base_failed = ~_all([rule.holds(c) for rule in base])
        failed = F.filter(
            F.array(*(F.when(~rule.holds(c), F.lit(rule.name)) for rule in rules)),
            lambda name: name.isNotNull(),
        )
        return F.struct(
            c.alias("counts"), base_failed.alias("base_failed"), failed.alias("failed"),
            (~base_failed & (F.size(failed) == 0)).alias("kept"),
        )

    return df.withColumn(into, let(counts, verdict))


def op7_quality_rules(spark, sf_dir):
    rows = judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = "quality.counts."
    return rows.select(
        "doc_id", count + "n_words", count + "word_chars", count + "n_symbols",
        count + "n_dup_lines", count + "n_repeat_words", "quality.base_failed", "quality.kept",
    )


def op7_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    rules = " and ".join(f"({rule.sql()})" for rule in RULES)
    spaces = r"[\x20\x09-\x0D]"
    return f"""
with texts as (
  select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents),
worded as (
  select row_no, doc_id, text,
    list_filter(string_split_regex(text, '{spaces}+'), lambda w: w <> '') as words,
    list_filter(string_split(text, chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
  from texts),
windows as (
  select row_no, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') as w
  from worded, unnest(range(1, len(words) - {WINDOW - 2})) as t(i)),
repeated as (
  select row_no, i from (
    select row_no, i, count(*) over (partition by row_no, w) as n from windows) where n > 1),
covered as (
  select row_no, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) as n from (
    select row_no, i, lead(i) over (partition by row_no order by i) as following from repeated)
  group by row_no),
counted as (
  select doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '{spaces}', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(text) - length(replace(text, '!', '')) as bigint) as n_exclaimed,
    cast(len(list_filter(words, lambda w: lower(w) in ({stops}))) as bigint) as n_stop_words,
    cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words
  from worded left join covered using (row_no)),
based as (
  select *, n_words < 20 or n_repeat_words * 1000 > n_words * 300 as base_failed from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {rules} as kept
from based"""
