import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

LLM_TABLES = ("documents", "pages", "benchmark", "labels")

# Empty, null, blank, repeated, odd and long texts; ids repeat and one is null.
ODD_DOCS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "src1", 5),
    (2, None, "en", "src1", None),
    (3, "", "en", None, 0),
    (4, " \t\n ", None, "src2", 4),
    (5, "Alpha BETA gamma delta epsilon zeta", "de", "src2", 5),
    (6, "one", "fr", "src3", 3),
    (6, "one", "fr", "src3", 3),
    (7, "password = hunter2hunter2 mail a.b@example.com", "en", "src1", 45),
    (None, "a row without an id", "en", "src1", 19),
    (8, "x" * 300_000, "en", "src2", 300_000),
    (9, "tok " * 50_000, "en", "src2", 200_000),
    (10, "éè \U0001f600 中文 café noir", "fr", "src3", 20),
]
CLASHES = ("spans", "hits", "score", "size", "rate", "value", "cid", "n", "comp", "toxic", "blob", "lang_", "main_text")


@pytest.fixture(scope="session")
def odd_docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHES)) for r in ODD_DOCS], schema)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in LLM_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def small_docs(duck):
    return duck.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()
