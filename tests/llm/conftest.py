import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n long, doc long, token long, score double, n_words long,"
    " _id long, _text string, _gone long, _doc long, b string, packed binary"
)
PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree and count every single leap it"
    " makes before the sun goes down behind the distant hills where nobody has walked for many long and silent years of waiting"
)
LONG = " ".join(f"word{i % 5003}x{i}" for i in range(40_000))
TEXTS = [
    (1, PROSE), (2, PROSE), (3, PROSE.replace("of waiting", "of pause")), (None, "a text without an id, of a few words"), (4, None), (5, ""),
    (6, " \n\t "), (7, LONG), (8, "twice the same row " * 30), (8, "twice the same row " * 30), (9, "héé ЖЗ 中文字 😀 \x00 ▁ x"), (10, "#### $$$ 123 <|>"),
    (11, "x"), (12, "y" * 5000), (13, None), (None, None),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows and names that may clash."""
    rows = []
    for i, (d, t) in enumerate(TEXTS):
        some = i % 3
        rows.append((d, t, ["en", None, "fr"][some], [None, "src0", "src0"][some], some or None, i, None, 1, 0.5, None, 3, "t", None, i, "b", None))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def pieces():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
