from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from shelfwise.llm.common import ship

    ship(spark)


@pytest.fixture
def documents(spark):
    """``documents(rows)``: rows (doc_id, text, lang, source)."""
    def make(rows, extra: str = "", values: tuple = ()):
        return spark.createDataFrame([(*r, len(r[1] or ""), *values) for r in rows], DOCS + extra)
    return make
