import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id int, data string"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of every awkward kind, with extra columns whose names operators use inside."""
    long = "word " * 3000 + "end"
    line = "A line of text that is long enough to be judged, number one."
    rows = [
        (1, line + "\nshort"),
        (2, line.replace("one", "two") + "\nother"),
        (3, line),
        (3, line),
        (4, ""),
        (5, None),
        (None, "no id here"),
        (None, None),
        (6, long),
        (7, long + " more"),
        (8, " \n\t "),
        (9, "é€😀 ▁▁  x\0y"),
    ]
    return spark.createDataFrame(
        [(i, t, "en", None if i == 3 else f"s{(i or 0) % 2}", None, 7, "d") for i, t in rows], DOCS
    )


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {row.doc_id: row.text or "" for row in corpus.collect()}
