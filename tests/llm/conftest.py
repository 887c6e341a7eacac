import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def vocab():
    return public_tokenizers.path


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, and columns with clashing names."""
    long = " ".join(f"word{k % 977} lorem" for k in range(30_000))
    rows = [(1, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox jumps over the lazy dog.", 0.5, "x"),
            (2, None, None, None), (3, "", 0.1, "y"), (4, " \n\t ", 0.1, "y"), (5, long, 0.2, "z"),
            (6, "  two  blanks \n\n and breaks\n", 0.2, "z"), (6, "  two  blanks \n\n and breaks\n", 0.2, "z"),
            (6, "another text under the same id", 0.2, "z"), (None, "a text without an id", 0.2, "z"),
            (7, "Ünï cödé 日本語 \U0001F600 <|im_start|> <|endoftext|> </s> ▁ \x00 \x1c x y", 0.2, "z"),
            (8, "x", 0.2, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, Kept string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
