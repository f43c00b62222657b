"""Registered queries of the text operators: SQL where there is some, plain Python elsewhere."""

import hashlib
import pathlib
import re
import zlib

import numpy as np
import pytest

from envstream.llm import binary, counts, mixing, pii, registry, toxicity
from envstream.llm.bpe import model_path as bpe_path

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = registry.registered(), registry.oracle()


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        connection.sql(f"create view {path.stem} as from '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(tables):
    return dict(tables.sql("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, tables, name):
    df, expected = QUERIES[name](spark, sf_dir), tables.sql(SQL[name])
    assert df.columns == expected.columns
    assert sorted(map(tuple, df.collect())) == sorted(expected.fetchall())


def test_mixing_gives_every_document_and_blocks_of_even_shares(spark, sf_dir, documents):
    rows = QUERIES["op1_source_mixing"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(documents)
    assert len({(r.block, r.place) for r in rows}) == len(rows)
    for r in rows:
        assert r.n_tokens == max(1, len(re.findall(r"[^\x20\x09-\x0D]+", documents[r.doc_id])))


def test_toxicity_ranks_held_out_rows(spark):
    larger = pathlib.Path("/root/testdata/sf0.01")  # the smallest table has 6 toxic rows held out
    if not larger.exists():
        pytest.skip("test tables are not here")
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, str(larger)).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{larger}/labels.parquet'")
    toxic = dict(labels.fetchall())
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.THRESHOLD)
    held = [(rows[d].score, y) for d, y in toxic.items() if rows[d].held_out]
    pairs = [(a, b) for a, y in held if y for b, z in held if not z]
    assert sum(a > b for a, b in pairs) >= 0.9 * len(pairs)
    # Almost no ordinary document is called toxic.
    assert sum(s >= toxicity.THRESHOLD for s, y in held if not y) <= 2


def brute_substring(docs, window=20):
    first, out = {}, {}
    for doc, text in sorted(docs.items()):
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i:i + window]), (doc, i))
    for doc, text in docs.items():
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < (doc, i):
                gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup_equals_brute_force(spark, sf_dir, documents):
    rows = QUERIES["op3_substring_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == brute_substring(documents)


def brute_ids(docs):
    from tokenizers import Tokenizer

    library, at, out = Tokenizer.from_file(bpe_path()), 0, []
    for doc, text in sorted(docs.items()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_binary_equals_the_library(spark, sf_dir, documents):
    rows = QUERIES["op4_token_binary"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == brute_ids(documents)


def test_token_counts_equal_the_library(spark, sf_dir, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=counts.model_path())
    rows = QUERIES["op5_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r.doc_id]
        n = len(library.encode(text))
        assert tuple(r)[1:] == (len(text.encode()), n, n > counts.LIMIT)


def test_chat_digests_equal_the_conversations(spark, sf_dir, tables):
    said = {}
    for conv, _, role, text in sorted(tables.sql(
            "select conv_id, turn, role, text from conversations").fetchall()):
        said.setdefault(conv, []).append((role, text or ""))
    said[-7] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    rows = QUERIES["op8_chat_formatting"](spark, sf_dir).collect()
    assert len(rows) == len(said)
    for r in rows:
        turns = said[r.conv_id]
        every = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        assert tuple(r)[1:5] == (
            len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > len(every)


PATTERNS = {  # fixed values
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind in pii.KINDS:
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_patterns_and_stay(spark, sf_dir, documents):
    rows = QUERIES["op10_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        spans = brute_spans(documents[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",")) if spans else True
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s.startswith(k + ":") for s in spans) for k in pii.KINDS]


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert mixing and binary
