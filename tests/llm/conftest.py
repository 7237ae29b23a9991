import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang[, source]]) rows, with columns that clash with results."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
        df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOCUMENTS)
        clashing = "'x' AS kept", "'x' AS score", "'x' AS size", "'x' AS n_words", "'x' AS ids", "'x' AS component_id", "'x' AS taken"
        return df.selectExpr("*", *clashing)

    return build


#: Nulls, blanks, short, very long and repeated rows.
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "word"), (None, "no id here"), (5, "a b c d e f g " * 30_000),
    (6, "same text " * 5), (6, "same text " * 5), (7, "ünï ▁ 😀  two  spaces "), (8, "#*$%&|<>"),
]
