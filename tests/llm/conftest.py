import pytest

from tellermill.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    ship(spark)

    def make(rows, columns=""):
        """Documents from (doc_id, text) pairs or whole rows."""
        full = [(*r, "en", "src0", len(r[1] or "")) if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, SCHEMA + columns)

    return make


#: Rows that every operator has to take: nulls, blanks, ties, repeats and a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (None, "two words here"),
    (None, None),
    (5, "word " * 30_000),
    (6, "Ünïcode — ﬀ ſ İ 漢字 е́ 🙂!! 'tis it's <|endoftext|>, A.B"),
    (7, "the same line\nthe same line\nanother line of text"),
]
