from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """``documents([(doc_id, text), ...])``: a table with the columns of ``documents``."""

    def make(rows, extra: str = ""):
        data = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(data, SCHEMA)
        # Columns whose names the operators might use themselves.
        return df.selectExpr("*", *(f"'x' as `{c}`" for c in extra.split())) if extra else df

    return make


@pytest.fixture(scope="session")
def sf_documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def sf_texts(sf_documents):
    return {r.doc_id: r.text or "" for r in sf_documents.select("doc_id", "text").collect()}
