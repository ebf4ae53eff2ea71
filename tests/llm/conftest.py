from __future__ import annotations

import random

import pytest

#: Names that the operators use inside; as extra columns they must do no harm.
CLASHING = ["id", "tk", "doc", "cuts", "part", "score", "shard", "n_words", "size", "half", "held", "_bucket", "fp"]


def doc_frame(spark, rows):
    """Documents from (doc_id, text), with clashing extra columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + \
        ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(
        [(i, t, "en", None if i is None else f"s{i % 3}", None if t is None else len(t),
          *["x"] * len(CLASHING)) for i, t in rows], schema)


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and long texts, repeated rows, equal texts, and ordinary ones."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 150)))) for i in range(20)]
    shared = " ".join(words[:80])
    rows += [(20, f"one {shared} two"), (21, f"three {shared}"), (22, shared), (23, shared)]
    rows += [(24, None), (25, ""), (26, " \t\n "), (None, "no id here"), (None, None)]
    rows += [(27, "again and again"), (27, "again and again"), (28, "ab " * 3000), (29, "ab " * 200)]
    rows += [(30, " ".join(rng.choices(words, k=60_000))), (31, "x" * 200_000)]
    return rows
