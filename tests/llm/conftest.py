import pytest

SCHEMA = "`a.b` string, h long, value int, text string, n int, doc_id long, lang string, same string, held_out string, `count` int"
LONG = "lorem ipsum dolor sit amet " * 20_000 + "x" * 200_000


def rows_of(pairs):
    """Rows of (doc_id, text, lang) among columns whose names operators use themselves."""
    return [("z", 1, 2, text, 3, doc_id, lang, "s", "no", 4) for doc_id, text, lang in pairs]


ODD = [
    (1, "The quick brown fox jumps over the lazy dog, again and again.", "en"),
    (2, None, "en"),
    (3, "", None),
    (None, "Nobody knows the trouble I have seen", "en"),
    (4, "The quick brown fox jumps over the lazy dog, again and again.", "en"),
    (4, "The quick brown fox jumps over the lazy dog, again and again.", "en"),
    (5, LONG, "en"),
    (6, "Ünïcödé ſtraße İstanbul 東京 🎉 <|endoftext|> á ﬁ \x1c\x85 ", "de"),
    (7, "123 !!! ---", None),
    (-9, "  \n\t ", "fr"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(ODD), SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
