import pytest

PASSAGE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ROWS = [
    (0, None, None, None),
    (1, "", "en", "src0"),
    (2, " \t\n\x0b\x0c\r ", "en", "src0"),
    (3, "a b c d e f g h i j", "en", "src1"),
    (4, "a  b c\td e f g h\ni j", "en", "src1"),
    (5, "abcdefghij", None, "src2"),
    (6, f"The first text. {PASSAGE} and its own end", "en", "src0"),
    (7, f"Another quite different text\n{PASSAGE} which ends otherwise", "en", "src0"),
    (8, PASSAGE, "en", "src0"),
    (9, PASSAGE, "en", "src0"),
    (9, PASSAGE, "en", "src0"),
    (None, "a text without an id, naïve café Ünïcödé \U0001f600 漢字 text", "de", None),
    (None, None, None, None),
    (10, LONG, "fr", "src0"),
    (11, LONG + " more", "fr", "src0"),
    (12, "And " * 90, "en", "src0"),
    (13, "x" * 5000, "en", "src0"),
    (14, "<|endoftext|> and <|im_end|> don't  we're it 'll  \n\n  x<|endoftext|>", "en", "src0"),
    (15, "Élle à çà ÉCOLE", "fr", "src3"),
    (16, "Élle à çà École", "fr", "src3"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with those the operators add."""
    rows = [(*r, 7, "x", 1.5) for r in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, id bigint, sha string, score double").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
