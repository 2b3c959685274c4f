"""Fixtures and edge cases shared by the corpus tests."""

import pytest

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from ``(doc_id, text)`` pairs, with an extra column whose name operators use inside."""

    def make(pairs, extra="text_hash"):
        rows = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in pairs]
        return spark.createDataFrame(rows, f"{DOC_SCHEMA}, {extra} string").repartition(3)

    return make


#: Nulls, empty, white space only, ties, repeated rows, long words, characters outside the BMP.
EDGES = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "same text here"), (5, "same text here"),
         (6, "same text here"), (7, "x" * 5000), (8, "é 👩‍👩‍👧   \x1c y\x85z"), (9, "word " * 3000)]
