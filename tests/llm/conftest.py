import pytest

LONG = "word" * 3000 + " " + " ".join(f"w{k % 97}" for k in range(30_000))


@pytest.fixture(scope="session")
def tokenizer():
    tokenizers = pytest.importorskip("public_tokenizers")
    return str(tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing names."""
    rows = [
        (1, "the quick brown fox, it's 12 o'clock!", "en", "a", 1),
        (2, None, "en", "a", 2),
        (3, "", None, None, 3),
        (4, " \t\n ", "de", "b", 4),
        (5, LONG, "en", "a", 5),
        (6, LONG, "en", None, 6),
        (7, "é é İΣ 한국어 <|endoftext|> x\x1cy", None, "b", 7),
        (7, "é é İΣ 한국어 <|endoftext|> x\x1cy", None, "b", 7),
        (8, "one two three", "en", "a", None),
        (None, "the quick brown fox, it's 12 o'clock!", "en", "a", 9),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score bigint")


@pytest.fixture(scope="session")
def none(spark, documents):
    return spark.createDataFrame([], documents.schema)
