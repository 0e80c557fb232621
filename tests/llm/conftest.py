import pytest


@pytest.fixture
def docs_of(spark):
    """Documents with extra columns of clashing names."""

    def make(rows, schema="doc_id long, text string, lang string, source string"):
        n = len(schema.split(","))
        df = spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], schema)
        for extra in ("size", "key", "component", "sid", "n_words", "gram", "block"):
            df = df.selectExpr("*", f"1 AS `{extra}`")
        return df

    return make


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
