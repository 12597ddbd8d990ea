import duckdb
import pytest

SF = "/root/testdata/sf0.001"

#: Texts that every operator on documents must survive: nulls, empty and blank
#: texts, ties, repeated rows, a clash of ids, a long text, odd characters.
TRICKY = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two three"), (4, "one two three"), (5, "one  two\nthree"),
    (None, "no id here at all, only some words to read"), (None, None), (6, "word " * 3000), (7, "x" * 50_000),
    (8, "a▁b ▁  日本語 𝄞 \x00 end"), (9, "Mail ann@example.com or +1 (212) 555-0100, card 4111 1111 1111 1111."),
    (10, "Mail ann@example.com or +1 (212) 555-0100, card 4111 1111 1111 1111."),
    (11, "Licensed under the MIT License. " * 3), (12, "# $ % & | < > *"), (13, "1 2 3 4 " * 2000),
    (14, "a@" + "a." * 3000 + "a"), (15, "9" * 30_000), (16, "+1" * 5000),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tricky(spark):
    return spark.createDataFrame(TRICKY, SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    """The same rows under extra columns whose names the operators use."""
    names = ["kept", "n_words", "_row", "content", "bucket", "c", "token", "found", "row", "salt"]
    rows = [(*r, *range(len(names))) for r in TRICKY]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {n} int" for n in names))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()
