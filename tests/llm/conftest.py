import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named as outputs."""
    words = " ".join(f"word{i % 97} the of and" for i in range(1200))
    near = words.replace("word5 ", "other ", 1)
    rows = [
        (1, words, "en", "a", 1, "x", None), (2, near, "en", "a", 1, "x", 1), (2, near, "en", "a", 1, "x", 1), (3, None, None, None, None, None, None), (4, "", "en", "a", 0, "x", 1),
        (None, "a null key with ten words in it, more or less so", "de", "b", 3, None, 2), (5, "It's <|endoftext|> two\tlines\n\nand 42 numbers é 日本 😀!!", "fr", "b", 9, "y", 2), (6, words, "en", None, 1, "x", 1), (7, " \n\t ", "en", "b", 1, "x", 1),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long, ids string, score int"
    extra = ["decoded", "spans", "n_words", "metrics", "kept", "sig", "sketch", "path", "held_out", "tails", "evidence", "host", "rule", "hits", "t", "k"]
    df = spark.createDataFrame(rows, kind)
    for c in extra:
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
