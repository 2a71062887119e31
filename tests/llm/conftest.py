import pytest

SF_DIR = "/root/testdata/sf0.001"

# Columns beside the ids and texts whose names operators use inside.
CLASHING = ("hash", "id", "fingerprint", "score", "terms", "text_hash", "cut", "kept_id", "part", "row")

FILLER = "the quick brown fox jumps over one lazy dog and runs away from seven small cats "


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """Id and text of all documents."""
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{n % 977} other{n % 1013}, again{n}" for n in range(30_000))
    same = "An ordinary text of more than ten words that stands here twice, as copies do."
    return [
        (1, None), (2, ""), (3, " \n\t\r "), (None, same), (None, None), (4, long), (5, same),
        (5, same), (5, same + " Or not."), (6, "\n\n"), (7, "é" * 5000), (8, "☃ 漢字 \U0001f600 " * 30),
        (9, "x"), (10, FILLER * 40),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """These rows with columns whose names clash with inner ones, nulls in them."""
    more = [(f"v{n}" if n % 2 else None) for n in range(len(CLASHING))]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *more) for i, t in odd_rows], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
