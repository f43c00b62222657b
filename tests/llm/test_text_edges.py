"""NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from envstream.llm import (
    binary, chat, counts, decontaminate, fmindex, jaccard, mixing, pii, rans, rules, substring,
    toxicity,
)
from envstream.llm.bpe import ChunkedBpe
from envstream.llm.bpe import model_path as bpe_path
from envstream.llm.components import components
from envstream.session import shared_dir

SCHEMA = ("doc_id long, text string, source string, lang string, row string, n long, doc string, "
          "token string, quality string, block string, _s string")
LONG = "alpha beta gamma delta " * 40_000
PASSAGE = " ".join(f"w{i}" for i in range(30))


def documents(spark, rows=None):
    if rows is None:
        rows = [
            (1, "The cat is on the mat and it was not in the house of the man for long", "a"),
            (2, None, "a"), (3, "", None), (4, "   \n\t ", "b"), (5, LONG, "b"),
            (6, PASSAGE, "a"), (6, PASSAGE, "a"), (7, "x " + PASSAGE + " y", None),
            (None, "no id here 4111 1111 1111 1111 a@b.cd", "a"), (8, "short", "a"),
        ]
    return spark.createDataFrame(
        [(*r, "en", "row", 9, "doc", "token", "q", "b", "s") for r in rows], SCHEMA)


def operators(spark):
    items = spark.createDataFrame(
        [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (4, "no id")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0), (None, 0, 1), (6, 1, None)],
                                   "doc_id long, quality int, toxic int")

    def tokens(docs):
        path = shared_dir(spark, "edge")
        binary.write_ids(docs, path)
        return binary.read_ids(spark, path)

    return {
        "mixing": mixing.mixed,
        "toxicity": lambda d: toxicity.scored(d, toxicity.fitted(d, labels)),
        "substring": substring.deduplicated,
        "binary": tokens,
        "counts": counts.token_counts,
        "decontaminate": lambda d: decontaminate.contaminated(d, items),
        "rules": rules.judged,
        "jaccard": jaccard.clusters,
        "first_of_each": jaccard.first_of_each,
        "pii": lambda d: pii.found_spans(d, pii.fitted(d)),
    }


NAMES = ("mixing", "toxicity", "substring", "binary", "counts", "decontaminate", "rules",
         "jaccard", "first_of_each", "pii")


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_empty_tables(spark, name):
    run = operators(spark)[name]
    docs = documents(spark)
    rows = run(docs).collect()
    if name == "first_of_each":
        assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "5", "6", "8", "None"]
    elif name == "mixing":
        assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    else:
        assert len(rows) == 10
    assert run(documents(spark, [])).collect() == []
    nothing = documents(spark, [(None, None, None), (None, None, None)])
    assert len(run(nothing).collect()) in (1, 2)


def test_columns_of_the_input_stay(spark):
    docs = documents(spark)
    for name in ("mixing", "toxicity", "decontaminate", "rules", "pii", "first_of_each"):
        got = operators(spark)[name](docs)
        assert set(docs.columns) - {"quality"} <= set(got.columns), name
        assert {r.row for r in got.select("row").collect()} == {"row"}


def test_substring_removes_later_windows_only(spark):
    docs = documents(spark, [
        (2, PASSAGE + " end", "a"), (1, "begin " + PASSAGE, "a"), (3, PASSAGE + " " + PASSAGE, "a"),
        (4, " ".join(["the"] * 60), "a"), (5, "one two", "a")])
    for hot in (2048, 1):
        rows = {r.doc_id: r for r in substring.deduplicated(docs, hot=hot).collect()}
        assert rows[1].n_removed == 0 and rows[1].kept == "begin " + PASSAGE
        assert rows[2].kept == "end" and rows[3].kept == ""
        # Of equal words only the first window is new.
        assert (rows[4].n_words, rows[4].n_removed) == (60, 59)
        assert rows[5].kept == "one two"


def test_substring_of_random_texts(spark):
    rng = random.Random(4)
    parts = [[rng.choice("abc") for _ in range(rng.randint(5, 40))] for _ in range(12)]
    texts = {i: " ".join(w for _ in range(rng.randint(0, 5)) for w in rng.choice(parts))
             for i in range(60)}
    docs = documents(spark, [(i, t, "a") for i, t in texts.items()])
    from test_text_queries import brute_substring

    expected = brute_substring(texts)
    for hot in (2048, 2):
        got = substring.deduplicated(docs, hot=hot, with_text=False).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == expected


@pytest.mark.parametrize("window", [6, 20])
def test_index_finds_every_window(window):
    rng = np.random.default_rng(1)
    text = rng.integers(1, 4, 2000)
    text[rng.integers(0, 2000, 30)] = 0
    text = np.append(text, 0).astype(np.int64)
    ends = np.flatnonzero(text == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    index = fmindex.FmIndex(text, 3, window)
    passage, at, low, high = index.match(starts, ends - starts)
    windows = {}
    for s, e in zip(starts, ends):
        for i in range(s, e - window + 1):
            windows.setdefault(tuple(text[i:i + window]), []).append(i)
    assert len(passage) == sum(map(len, windows.values()))
    for i, a, b in zip(starts[passage] + at, low, high):
        assert sorted(index.suffixes[a:b]) == windows[tuple(text[i:i + window])]


def test_index_begins_anew_after_a_word_it_does_not_have():
    text = np.array([1, 2, 3, 1, 2, 3, 1, 0])
    index = fmindex.FmIndex(text, 4, 5)
    other = np.array([1, 2, 3, 1, 2, 4, 2, 3, 1, 2, 3])
    passage, at, low, high = index.match(np.array([0]), np.array([11]), other)
    assert sorted(at.tolist()) == [0, 6] and (high - low).tolist() == [1, 1]


@pytest.mark.parametrize("n", [1, 5, 999, 70_000, 300_000])
def test_coded_tokens_come_back_from_any_checkpoint(n):
    rng = np.random.default_rng(n)
    tokens = (rng.zipf(1.3, n) % 50_000).astype(np.uint32)
    freq = rans.Table.from_bytes(rans.Table.of(tokens).to_bytes())
    blocks, decoder = rans.encode(tokens, freq), rans.Decoder(freq)
    assert (np.concatenate([decoder.block(b) for b in blocks]) == tokens).all()
    first = tokens[:blocks[0]["n"]]
    for a, b in ((0, 1), (n // 3, n // 2), (len(first) - 1, len(first))):
        assert (decoder.block(blocks[0], a, b) == first[a:b]).all()
    spoiled = {**blocks[0], "crc": blocks[0]["crc"] ^ 1}
    with pytest.raises(ValueError):
        decoder.block(spoiled)


def test_ids_come_back_in_order(spark):
    path = shared_dir(spark, "edge")
    docs = documents(spark)
    binary.write_ids(docs, path, segment=10)
    rows = binary.read_ids(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 0 for r in rows)


PIECES = [" ", "a", "b ", "  ", "é", "the ", "\n", " \n", "😀", "'s", "<|endoftext|>", "\x1c",
          "\xa0", ".\n", "The", " \t ", "▁", "x" * 30]


def test_chunks_give_the_librarys_ids():
    from tokenizers import Tokenizer

    library, model = Tokenizer.from_file(bpe_path()), ChunkedBpe(bpe_path(), cache=40)
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 50))) for _ in range(1500)]
    for text, data in zip(texts, model.encode(texts)):
        assert np.frombuffer(data, np.uint32).tolist() == library.encode(
            text, add_special_tokens=False).ids


def test_spliced_counts_are_the_librarys():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=counts.model_path())
    counter = counts.PieceCounter(counts.model_path(), span=64, overlap=8)
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 200))) for _ in range(300)]
    assert counter.counts(texts) == [len(library.encode(t)) for t in texts]
    assert counter.splices and counter.widened


def test_hits_are_mapped_to_the_text(spark):
    text = "Ünder— " + PASSAGE.upper().replace(" ", " -- ") + " é"
    docs = documents(spark, [(1, text, "a"), (2, PASSAGE[:20], "a")])
    items = spark.createDataFrame([(5, PASSAGE), (9, PASSAGE[6:]), (7, "Under")],
                                  "item_id long, text string")
    for block in (1 << 20, 50):
        rows = {r.doc_id: r.leak for r in
                decontaminate.contaminated(docs, items, block_bytes=block).collect()}
        span = rows[1].spans[0]
        assert text[span.begin:span.end] == PASSAGE.upper().replace(" ", " -- ")
        assert (rows[1].items, rows[1].n_hit) == ([5, 9], 30) and rows[2].n_hit == 0


def test_near_copies_hang_together(spark):
    rng = random.Random(8)
    base = [f"v{rng.randint(0, 10**6)}" for _ in range(200)]
    texts = {}
    for i in range(80):  # near copies of one text, and of each other
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(200)] = f"u{rng.randint(0, 10**6)}"
        texts[i] = " ".join(words)
    for i in range(80, 120):  # share a passage, no more
        texts[i] = " ".join(base[:30] + [f"z{rng.randint(0, 10**6)}" for _ in range(100)])
    texts[120] = texts[121] = "a b c"
    texts[122] = "A B  c"
    docs = documents(spark, [(i, t, "a") for i, t in texts.items()])
    sets = {i: set(jaccard.shingles(t).tolist()) for i, t in texts.items()}
    root = dict.fromkeys(texts)
    for i in texts:
        todo, seen = [i], {i}
        while todo:
            at = todo.pop()
            for j in texts:
                if j not in seen and 100 * len(sets[at] & sets[j]) >= 75 * len(sets[at] | sets[j]):
                    seen.add(j)
                    todo.append(j)
        root[i] = min(seen)
    for dense in (64, 1):
        got = jaccard.clusters(docs, dense=dense).collect()
        assert {r.doc_id: r.component_id for r in got} == root
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(70, 60)], "a long, b long")
    rows = components(links).collect()
    assert {r.node: r.root for r in rows} == {**dict.fromkeys(range(51), 0), 60: 60, 70: 60}


def test_exponent_meets_the_targets(spark):
    rows = [(i, "w " * 50, "big") for i in range(400)] + [
        (1000 + i, "w " * 50, f"s{i % 9}") for i in range(90)]
    docs = documents(spark, rows)
    flat = mixing.mixed(docs, entropy=0.99, max_repeats=None)
    shares = {r.source: r.n for r in flat.groupBy("source").agg(
        F.sum("_mix.n_tokens").alias("n")).collect()}
    p = np.array(list(shares.values())) / sum(shares.values())
    assert abs(-(p * np.log(p)).sum() / np.log(10) - 0.99) < 0.02
    limited = mixing.mixed(docs, entropy=0.99, max_repeats=2.0)
    most = limited.groupBy("doc_id").count().agg(F.max("count"), F.min("count")).first()
    assert tuple(most) == (2, 1)
    budget = mixing.mixed(docs, budget=10_000)
    assert abs(budget.agg(F.sum("_mix.n_tokens")).first()[0] - 10_000) < 10 * 50 * 2


def test_blocks_hold_every_source_by_weight(spark):
    rows = [(i, "w " * 5000, f"s{i % 4}") for i in range(1600)]
    blocks = mixing.mixed(documents(spark, rows)).groupBy("_mix.block", "source").count().collect()
    by = {}
    for r in blocks:
        by.setdefault(r.block, []).append(r["count"])
    assert len(by) == 8 and all(len(n) == 4 and max(n) - min(n) <= 2 for n in by.values())


def test_windows_keep_budget_system_and_every_turn_once(spark):
    rows = [(1, 0, "system", "be brief"), (2, None, "user", None), (2, 1, None, "x <|end|> \\ y")]
    rows += [(1, t, "assistant" if t % 2 == 0 else "user", f"turn {t} " + "word " * 40)
             for t in range(1, 200)]
    rows += [(3, 0, "user", "big " * 3000), (3, 1, "assistant", "a"), (3, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.windows(df).cache()
    for w in made.where("conv_id = 1").collect():
        assert w.tokens <= chat.BUDGET and w.formatted.startswith("<|system|>\nbe brief<|end|>\n")
        assert all(w.formatted[s.begin:s.end].startswith("turn ") for s in w.loss)
    assert made.agg(F.sum("n_new")).first()[0] == len(rows)
    assert [r.over_budget for r in made.where("conv_id = 3").orderBy("window").collect()] == [
        True, False]
    read = made.where("conv_id = 2").orderBy("block", "window").select(
        F.explode(chat.turns_of(F.col("formatted")))).select("col.*").collect()
    assert [tuple(r) for r in read] == [("user", ""), ("", "x <|end|> \\ y")]
    assert chat.windows(df.limit(0)).collect() == []


def test_escaped_texts_come_back(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(["<|", "|>", "\\", "</s>", "[INST]", "[/INST]", "<s>", "<", "[",
                                  "|", "a", "$1", "\n"], k=12)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"),
                       chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_field_adds_what_repeats(spark):
    good = "4111 1111 1111 1111"
    rows = [(i, f"call +1 (743) 555-3824 pay {good} or {4000 + i} mail x{i}@mail.org to 10.0.0.{i}",
             "a") for i in range(60)]
    field = pii.fitted(documents(spark, rows))
    # The second number runs on into other digits, which the pattern drops.
    text = "call +1 (743) 555-3824 now, +1 (743) 555-3824 19 20 21"
    kinds = [s.kind for s in field.spans(text, pii.base_spans(text))]
    assert kinds.count("phone") >= 1 and set(kinds) <= set(pii.KINDS)
    base = pii.base_spans(text)
    assert set(base) <= set(field.spans(text, base))
    assert field.spans("nothing here", []) == []


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "a@" * 50_000, "1." * 100_000, "+1 " * 50_000):
        pii.base_spans(text)


def test_native_operators_run_no_python(spark, sf_dir):
    from envstream.llm import registry

    for name in ("op1_source_mixing", "op7_quality_rules", "op8_chat_formatting"):
        plan = registry.registered()[name](spark, sf_dir)._jdf.queryExecution().executedPlan()
        assert not any(k in plan.toString() for k in ("Python", "Pandas", "Arrow")), name
