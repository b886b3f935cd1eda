import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, score string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, exact and near copies, repeated rows, columns whose names clash with results."""
    base = " ".join(f"word{i} Stone river" for i in range(60))
    near = base.replace("word30", "other30")
    long = "\n".join(f"line {i} of a very long text with many words in it" for i in range(3000))
    shared = "this line stands in several documents of the set"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", None),
        (4, None, None, None),
        (5, "", "en", "b"),
        (6, " \t\n ", None, "b"),
        (7, long, "en", "b"),
        (8, shared + "\nfirst own line here is long", "en", "b"),
        (9, "  " + shared.upper() + "\t\nx", "de", "b"),
        (10, shared + "\n" + shared, "de", "b"),
        (11, "éà ü 日本 🎉 ᚠᚡ x", "de", None),
        (None, base, "en", "a"),
        (12, "two words", "en", "c"),
        (12, "two words", "en", "c"),
        (13, "two words", "en", "c"),
    ]
    return spark.createDataFrame([(*r, None, 7, "clash") for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
