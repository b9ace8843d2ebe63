
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(id, text)`` or ``(id, text, source)`` rows, with columns whose
    names the operators use inside."""
    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            for c in ("id", "hash", "size", "key", "copies", "th", "row", "base", "n_lines", "digest", "_id"):
                df = df.selectExpr("*", f"'x' AS `{c}`")
        return df
    return make


@pytest.fixture(scope="session")
def sf_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")




@pytest.fixture(scope="session")
def sf_rows(sf_docs):
    return [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()]
