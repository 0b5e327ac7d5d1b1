import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside: as extra columns they must not get in the way.
CLASHING = "row tag kept norm maybe gid digit length print key root h size of copies score label words ids spans html".split()


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, lang, source) tuples, with extra columns whose names clash."""

    def make(rows):
        df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], COLUMNS)
        return df.selectExpr("*", *(f"'other' AS `{c}`" for c in CLASHING))

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, equal texts, one long text."""
    long_text = " ".join(f"word{i % 977} número{i % 31}" for i in range(30_000))
    same = "The same text stands here more than once, with é and ü."
    return [
        (1, same, "en", "a"),
        (2, same.replace(" ", " \t\n "), "en", "b"),
        (2, same.replace(" ", " \t\n "), "en", "b"),
        (None, same, "en", "a"),
        (3, None, None, None),
        (4, "", "de", "a"),
        (4, "", "de", "a"),
        (5, " \t ", "de", "c"),
        (6, long_text, "es", "c"),
        (7, long_text + " end", "es", "c"),
        (None, None, None, "a"),
        (8, "token = 'abcdef123' <|endoftext|> 12345", "en", None),
        (9, "中文文本 and 日本語 のテキスト 🎉", "zh", "b"),
        (10, "x" * 200_000, "en", "b"),
    ]
