import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang]) tuples."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


PASSAGE = " ".join(f"passage{i} of words" for i in range(40))
LONG = " ".join(f"w{i}" for i in range(30000))


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls, empty, blank, very long, without spaces, repeated rows, ties, clashing column names."""
    rows = [
        (None, None, None), (None, "null id " + PASSAGE, "en"), (1, None, "de"), (2, "", None), (3, " \n\t ", "en"),
        (4, LONG, "en"), (5, "x" * 40000, "fr"), (6, PASSAGE, "en"), (6, PASSAGE, "en"), (7, PASSAGE + " more", "en"),
        (8, "one", "en"), (9, "▁ ☃ 🙂 \\ <0x41> ### </turn>", "es"), (10, "\x00\x1f\x0b", "en"),
    ]
    names = ["fp", "root", "text_hash", "hash", "words", "at", "width", "component_id", "removed", "kept", "removed_spans", "label", "held", "id", "n", "data"]
    return docs_of(rows).withColumns({n: F.lit(1) for n in names})


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(4, 1, 0), (6, 1, 0), (5, 0, 0), (8, None, None), (None, 1, 0), (6, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def items(spark):
    rows = [(1, PASSAGE), (2, "one"), (None, "w0 w1 w2"), (4, None), (5, ""), (2, "one"), (6, "never seen words in this order")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="session")
def small_tables():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con
