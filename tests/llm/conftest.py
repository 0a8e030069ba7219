import pytest

LONG = " ".join(f"word{i % 977} of" for i in range(20_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and extra
    columns whose names operators use themselves."""
    plain = "The river and the town are on the map, and it is as good as any. " * 12
    rows = [(1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain, None, "b"), (3, None, "en", None),
            (4, "", None, "a"), (None, plain + "x", "en", "a"), (None, None, None, None), (5, LONG, "en", "b"),
            (6, "  \n\t ", "en", "b"), (7, "one two", "zz", "c"), (7, "three four\n\nfive", "de", "c")]
    return spark.createDataFrame(
        [(*r, len(r[1] or ""), "x", 0.5, 9) for r in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "key string, score double, copy int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
