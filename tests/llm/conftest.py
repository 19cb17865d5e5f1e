from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang, source]); two partitions, so that order is not given."""

    def build(*rows, extra=None):
        full = [(r[0], r[1], *(r[2:] or ("en", "s1")), len(r[1] or "")) for r in rows]
        made = spark.createDataFrame(full, DOCS).repartition(2)
        if extra:  # columns that an operator uses itself
            made = made.selectExpr("*", *[f"'mine' AS {name}" for name in extra])
        return made

    return build


def long_text(words: int, seed: int = 1) -> str:
    return " ".join(f"w{(i * 7919 + seed) % 5003}" for i in range(words))
