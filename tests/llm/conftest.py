import pytest

#: Texts that no operator may trip over.
ODD_TEXTS = [
    None, "", " ", "\n\n \t", "one", "one two", "One TWO one", "a b c", "ÀÉ ß é Σς İ", "日本 😀  x y",
    "#" * 40 + " $%&", "line one\nline one\nline two\n\nline one", "</turn> \\### x", "<|endoftext|> a<|startoftext|>b",
    "▁a ▁▁ b  c   d ", " lead", "trail ", "x" * 5000, "a b c d " * 2000, "aaaa " * 50, "word " * 60000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, repeated rows, null keys, nulls elsewhere, and columns with names that operators use inside."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id here", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS row", "'x' AS words", "2.0 AS fp", "doc_id AS component", "'k' AS kept", "0 AS ids", "1 AS bucket"
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
