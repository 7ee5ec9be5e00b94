from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or fuller tuples, with extra columns whose names the operators use inside."""

    def build(rows, schema=DOCS):
        full = [tuple(row) + (None,) * (5 - len(row)) for row in rows]
        frame = spark.createDataFrame(full, schema)
        from pyspark.sql import functions as F

        for name in ("key", "rep", "site", "keys", "row", "label", "good", "score", "root", "kept", "lines", "digest", "bits"):
            frame = frame.withColumn(name, F.lit("extra"))
        return frame

    return build


@pytest.fixture
def odd_rows():
    """Null and empty texts, a null id, repeated rows and a very long text."""
    long = " ".join(f"word{k % 977} tail{k}" for k in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (None, "no id at all"), (4, "one"), (5, "same row here"), (5, "same row here"), (6, long)]
