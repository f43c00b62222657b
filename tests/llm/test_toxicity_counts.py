"""The counts of the toxicity models against plain Python that keeps every expression."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from envstream.llm import toxicity


class Plain:
    """Kneser-Ney models of five letters by dictionaries."""

    def __init__(self, texts):
        self.full = Counter()
        for text, toxic in texts:
            for word in toxicity.normal_words(text):
                padded = "\x02" * 4 + word + "\x03"
                for i in range(len(word) + 1):
                    self.full[padded[i:i + 5], toxic] += 1
        self.context, self.types = Counter(), Counter()
        for (gram, toxic), n in self.full.items():
            self.context[gram[:4], toxic] += n
            self.types[gram[:4], toxic] += 1
        before = defaultdict(set)
        for gram, _ in self.full:
            before[gram[-3:]].add(gram)
        self.middle = {g: len(v) for g, v in before.items()}
        self.base, self.base_types, self.letters = Counter(), Counter(), Counter()
        for g, n in self.middle.items():
            self.base[g[:2]] += n
            self.base_types[g[:2]] += 1
            self.letters[g[2]] += 1
        self.n = sum(self.letters.values())

    def ratio(self, word):
        padded, out = "\x02" * 4 + word + "\x03", 0.0
        for i in range(len(word) + 1):
            gram = padded[i:i + 5]
            low = (self.letters[gram[4]] + 0.5) / (self.n + 0.5 * len(self.letters) + 1)
            context = gram[2:4]
            if self.base[context]:
                seen = max(self.middle.get(gram[2:], 0) - 0.75, 0)
                low = (seen + 0.75 * self.base_types[context] * low) / self.base[context]
            logs = []
            for k in (1, 0):
                sums, p = self.context[gram[:4], k], low
                if sums:
                    p = (max(self.full[gram, k] - 0.75, 0)
                         + 0.75 * self.types[gram[:4], k] * low) / sums
                logs.append(math.log(p + 1e-12))
            out += logs[0] - logs[1]
        return out


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return (spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
            spark.read.parquet(f"{sf_dir}/labels.parquet"))


def test_every_expression_keeps_its_own_counts(tables):
    docs, labels = tables
    texts = dict(docs.collect())
    marks = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    plain = Plain([(texts[d], int(y > 0)) for d, y in marks.items()
                   if d in texts and texts[d] and zlib.crc32(str(d).encode()) % 3 != 1])
    scorer = toxicity.Scorer(toxicity.fitted(docs, labels)[0])
    words = sorted({w for t in texts.values() for w in toxicity.normal_words(t or "")})
    ratios, letters = scorer._ratios(words)
    assert letters.tolist() == [len(w) + 1 for w in words]
    assert np.abs(ratios - [plain.ratio(w) for w in words]).max() < 1e-6


def test_counts_beyond_the_broadcast_are_joined(spark, tables):
    docs, labels = tables
    docs = docs.unionByName(spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, " \t"), (-4, "so so so"), (-5, "中文 x\U0001F600y")], docs.schema))
    sent, joined = toxicity.fitted(docs, labels), toxicity.fitted(docs, labels, most_keys=1000)
    assert isinstance(joined[0], toxicity.Joined)

    def scores(model):
        rows = toxicity.scored(docs, model, keep=["doc_id"]).collect()
        return sorted((r.doc_id, round(r.toxicity, 6)) for r in rows)

    assert scores(joined) == scores(sent)


def test_the_joined_rows_keep_their_columns_and_copies(spark, tables):
    docs, labels = tables
    docs = docs.unionByName(docs.limit(3))
    model = toxicity.fitted(docs, labels, most_keys=1000)
    rows = toxicity.scored(docs, model).select("doc_id", "text").collect()
    assert sorted(rows, key=str) == sorted(docs.collect(), key=str)


def test_the_table_tells_keys_from_unseen_ones():
    rng = np.random.default_rng(3)
    letters = [rng.integers(0, 2**20, 200_000) for _ in range(3)]
    seen, unseen = [c[:100_000] for c in letters], [c[100_000:] for c in letters]
    counts = np.arange(200_000.0).reshape(-1, 2)
    table = toxicity.Table(toxicity._hash("m", seen, 0), counts)
    assert (table.look("m", seen) == counts).all()
    assert not table.look("m", unseen).any() and not table.look("k", seen).any()


def _plain_measures(scorer, text):
    """Every word counts, whatever stands before it."""
    words = toxicity.normal_words(text)
    if not words:
        return [0.0] * toxicity.N_MEASURES
    ratios, letters = scorer._ratios(words)

    def mean(i, n):
        return sum(ratios[i:i + n]) / sum(letters[i:i + n])

    telling = sum(r > toxicity.TELLING for r in ratios)
    stretches = [max(mean(i, min(n, len(words))) for i in range(max(1, len(words) - n + 1)))
                 for n in toxicity.STRETCHES]
    return [mean(0, len(words)), *stretches, telling / len(words), math.log1p(telling),
            math.log1p(len(words)) / 10]


def test_measures_against_plain_python(tables):
    docs, labels = tables
    scorer = toxicity.Scorer(toxicity.fitted(docs, labels)[0])
    texts = [r.text or "" for r in docs.limit(60).collect()]
    texts += ["", " \t -- ...", "so so so so so, so", "one", "(one) 'one' -- one_", "a b " * 40 + "c"]
    got = np.array(scorer.measures(texts))
    assert np.abs(got - [_plain_measures(scorer, t) for t in texts]).max() < 1e-5
    assert [scorer.measures([t])[0] for t in texts] == got.tolist()


def test_few_words_in_the_cache_change_nothing(tables, monkeypatch):
    docs, labels = tables
    counts = toxicity.fitted(docs, labels)[0]
    texts = [r.text or "" for r in docs.limit(40).collect()]
    wanted = toxicity.Scorer(counts).measures(texts)
    monkeypatch.setattr(toxicity, "CACHE", 50)
    scorer = toxicity.Scorer(counts)
    assert [m for t in texts for m in scorer.measures([t])] == wanted


def test_beyond_the_broadcast_no_text_is_written(spark, tables, monkeypatch):
    """What is kept apart are words and expressions. If the scores of all expressions that
    occur can be sent, no text is shuffled either, else each once."""
    docs, labels = tables
    docs = docs.unionByName(docs.limit(5))
    sent = toxicity.fitted(docs, labels)
    model = toxicity.fitted(docs, labels, most_keys=1000)
    written, wanted = [], None
    monkeypatch.setattr(toxicity, "materialise", lambda df, f=toxicity.materialise: (
        written.append(df.columns), f(df))[1])
    for most, shuffled in ((1 << 20, False), (1000, True), (0, True)):
        model[0].most_keys = most
        scored = toxicity.scored(docs, model)
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
        assert ("Join" in plan) == shuffled
        wanted = wanted or sorted(
            (r.doc_id, round(r.toxicity, 6)) for r in toxicity.scored(docs, sent).collect())
        assert sorted((r.doc_id, round(r.toxicity, 6)) for r in scored.collect()) == wanted
    assert written and not any({"text", "row"} & set(columns) for columns in written)
