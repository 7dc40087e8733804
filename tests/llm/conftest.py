import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_df(spark, tmp_path):
    """Rows (doc_id, text[, lang[, source]]) as a stored documents table."""
    def make(rows, name="documents"):
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(full, DOCS).repartition(3).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return make
