import pytest

LONG = " ".join(f"wort{k % 977} naïve, “{k}”." for k in range(20000))
EDGE = [
    (5, None), (1, ""), (2, " \n "), (3, "one two"), (4, "a b c d e"), (6, LONG), (7, "x\ty　z\x00 ▁w <|endoftext|> </s>"),
    (8, "same text here for all of us to read"), (8, "same text here for all of us to read"), (9, "same text here for all of us to read"),
    (None, "an id is missing here but the text is fine"), (10, "日本語のテキスト 😀 ñandú É"), (10, "another text with the same id"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated ids and rows, and columns with clashing names."""
    rows = [(i, t, "xx", "s", -1, 0.5, 1, 2, "k") for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_tokens int, comp int, copy string")


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("false")
