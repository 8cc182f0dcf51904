import pytest


@pytest.fixture
def docs(spark):
    """Rows with what makes operators stumble: nulls, empty and very long texts, repeats, and columns of clashing names."""

    def make(rows=None, extra=True):
        rows = [(1, "The mit license, under the MIT License. " * 3, "en", "src1"), (2, None, "en", "src1"), (2, "", None, None), (3, "wörd " * 4000, "de", "src2"), (3, "wörd " * 4000, "de", "src2"), (None, "no id at all", "en", "src1"), (-7, "!!! 123 ...", "fr", "src2")] if rows is None else rows
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        from pyspark.sql import functions as F

        df = df.withColumn("n_chars", F.length("text").cast("long"))
        return df.withColumns({c: F.lit("x") for c in ("shard", "size", "component", "fp", "key", "epoch", "last_place", "row_key", "leaf_lang", "full", "text_parts", "part", "found_secrets")}) if extra else df

    return make


@pytest.fixture
def rows():
    def collect(df):
        return [r.asDict(recursive=True) for r in df.collect()]

    return collect
