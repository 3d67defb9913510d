"""Small document frames for the corpus operators."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(rows):
        full = [(*r, "en", "src1")[:4] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in full], DOCS
        )

    return build


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
