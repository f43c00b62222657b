"""What the field of personal data learns from."""

import numpy as np
import pytest

from envstream.llm import pii


def texts(n):
    return [f"call +1 (743) 555-{3000 + i} or {i} {i * i} mail x{i}@mail.org to 10.0.{i % 7}.{i % 200}"
            for i in range(n)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(t,) for t in rows], "text string").repartition(parts)


def same(one, other):
    return all(np.allclose(getattr(one, k), getattr(other, k), atol=1e-9)
               for k in ("weights", "chain", "skip"))


@pytest.mark.parametrize("limits", [{}, {"fit_docs": 60}, {"fit_tokens": 150}])
def test_copies_of_a_text_teach_once(spark, limits):
    rows = texts(200)
    hot = rows + [rows[5]] * 900 + [rows[6]] * 700
    one = pii.fitted(frame(spark, rows), **limits)
    other = pii.fitted(frame(spark, hot, parts=7), **limits)
    assert same(one, other)
