"""A folder for what operators write, and small tables with odd rows."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Documents of texts; an entry may also be (doc_id, text, lang)."""

    def made(rows):
        full = []
        for k, row in enumerate(rows):
            doc_id, text, lang = row if isinstance(row, tuple) else (k, row, "en")
            full.append((doc_id, text, lang, "a", None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENT)

    return made


@pytest.fixture
def saved(spark, tmp_path, documents):
    """A folder that holds ``documents`` and whatever else is given, as Parquet."""

    def made(rows, **tables):
        documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
        for name, frame in tables.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return made
