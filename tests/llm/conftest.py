import pytest

from tenderscope.session import local_session

LABEL = [(i, 1, int(i % 7 == 0)) for i in range(0, 200)]


@pytest.fixture(scope="session")
def spark():
    return local_session("*", 8, app="tenderscope-llm-tests")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    copies, ties, and extra columns whose names clash with the operators' own."""
    long = " ".join(f"word{i % 997} and{i % 13}." for i in range(30_000))
    body = ["The quick brown fox jumps over the lazy dog near the river bank today. It was seen by many people there. Nobody knew why.",
            "Reach me at a.b@mail1.example.com or +1 (202) 555-0101. The host is 10.0.0.256 and 10.0.0.25 too.", "", "   \n\t ", "x", long]
    rows = [(i, body[i % 6] if i % 9 else None, "en", [None, "src0", "src1", "é", "z"][i % 5], i) for i in range(60)]
    rows += [(None, "no id here", "en", "src0", 1), (None, "no id here", "en", "src0", 1), (None, None, None, None, None),
             (7, body[1], "en", "src0", 2), (7, body[1], "en", "src0", 2), (8, "another text under a used id", None, "src1", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F
    clash = ["row", "h", "size", "k", "a", "z", "fp", "root", "piece", "hash", "group", "score", "spans", "base", "target", "bucket", "copies", "slot", "shard"]
    return df.withColumns({c: F.lit(3) for c in clash}).repartition(5).checkpoint()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(LABEL + [(None, None, 1), (3, None, None)], "doc_id long, quality int, toxic int")
