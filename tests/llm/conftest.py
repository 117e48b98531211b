import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Null, empty, blank, long, repeated and odd texts; every operator must take them.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "Same text here, five words or more. " * 3),
    (6, "Same text here, five words or more. " * 3), (7, "Same text here, five words or more. " * 3), (None, "no id at all"),
    (None, None), (8, "zero\x00byte é 漢字 \U0001f600    'll I'LL <|endoftext|> x<|endoftext|>"),
    (9, "a" * 5000), (10, "long line " * 20000), (11, "\n\n\n\r\n  \n"), (12, "​́ İ \U000e0041 힣"),
]


@pytest.fixture
def odd(spark):
    rows = [(None if i is None else 100_000 + i, t, None, None if t is None else f"src{len(t) % 3}", None if t is None else len(t)) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def same_rows(got, want):
    def normal(rows):
        return sorted((tuple(r) for r in rows), key=repr)

    assert normal(got) == normal(want)
