import pytest

from innspark.llm.common import ship

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use themselves
          "th string, pos string, len string, hash string, w string, n int, rep string, key string, "
          "block string, p string, size string, copies string, label string, start string, hits string")
LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) with clashing extra columns."""
    def make(rows):
        full = []
        for r in rows:
            doc, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r
            full.append((doc, text, lang, source, None if text is None else len(text),
                         *["x"] * 5, 3, *["x"] * 9))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated rows, ties."""
    return [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"),
            (4, LONG, "en", "b"), (5, LONG, None, "b"), (5, LONG, None, "b"), (None, "no id here at all", "en", None),
            (None, None, None, None), (6, "a b", "fr", None), (7, "A B", "fr", "é"),
            (8, "one two three four five six seven", "en", "b"), (9, "日本語 テキスト 😀 ñandú", None, "c"),
            (9, "日本語 テキスト 😀 ñandú", None, "c")]
