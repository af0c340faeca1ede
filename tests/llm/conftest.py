import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, `Component_ID` string, spans string"


def rows_of(texts):
    """Documents with odd rows: a null id, null other columns, a repeated row, extra columns."""
    rows = [(i, t, "en", "src0", None if t is None else len(t), "x", None, "y") for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, "a row without an id", None, None, None, None, None, None)]


@pytest.fixture()
def documents(spark, tmp_path):
    """Write texts as documents.parquet (a directory of part files) and give the folder."""
    def make(texts):
        spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)
    return make


@pytest.fixture()
def no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    return str(tmp_path / "none")
