"""Stages of the pipeline against plain versions that share no code with them."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from envstream.llm.bpe import model_path


def plain_targets(tokens):
    """Source -> tokens of the mixture: entropy 0.95 of the highest, at most twice."""
    p = np.array(list(tokens.values())) / sum(tokens.values())

    def at(a):
        w = p ** a / (p ** a).sum()
        return -(w * np.log(w)).sum(), (p ** (a - 1)).max() / (p ** (a - 1)).min()

    def boundary(below):
        low, high = 0.0, 1.0
        if below(1.0):
            return 1.0
        for _ in range(60):
            half = (low + high) / 2
            low, high = (half, high) if below(half) else (low, half)
        return high

    a = boundary(lambda x: at(x)[0] >= 0.95 * math.log(len(p)) - 1e-12)
    if at(a)[1] > 2:
        a = boundary(lambda x: at(x)[1] > 2)
    times = p ** (a - 1) / (p ** (a - 1)).min()
    return dict(zip(tokens, times * np.array(list(tokens.values()))))


def test_the_mixture_has_the_plain_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: (r.source, max(1, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))))
            for r in docs.collect()}
    tokens, longest = Counter(), defaultdict(int)
    for source, n in rows.values():
        tokens[source] += n
        longest[source] = max(longest[source], n)
    mixed = corpus_pipeline.to_target_weights(spark, docs, sf_dir).collect()
    copies, found = Counter(r.doc_id for r in mixed), Counter()
    for doc, n in copies.items():
        found[rows[doc][0]] += n * rows[doc][1]
    assert set(copies) == set(rows) and max(copies.values()) <= 2
    for source, target in plain_targets(tokens).items():
        slack = 2 + 1e-4 * target
        assert target - slack <= found[source] < target + longest[source] + slack
        assert len({copies[d] for d, (s, _) in rows.items() if s == source}) <= 2


def test_written_ids_are_those_of_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    library = Tokenizer.from_file(model_path())
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]  # the end of a text
        expected.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = corpus_pipeline.to_token_ids(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(expected)
