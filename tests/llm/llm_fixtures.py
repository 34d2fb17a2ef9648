"""Documents for the tests of the corpus operators."""

import pytest
from llm_words import words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names the operators use inside.
CLASH = {
    "size": "1", "score": "'x'", "id": "2", "tag": "3", "key": "4", "term": "5", "words": "6", "component": "7",
    "target": "8", "anchor": "9", "spans": "'y'", "url": "'z'", "_m_id": "1", "mix_taken": "0", "hit": "'h'",
    "toxicity": "1", "secret_spans": "'s'", "train_id": "1", "train_label": "0", "vec": "0", "flat": "0",
}


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows, with clashing extra columns on demand."""

    def make(rows, clash=False):
        df = spark.createDataFrame([(i, t, "en", s, len(t) if t else None) for i, t, s in rows], DOCS)
        return df.selectExpr("*", *[f"{v} AS {k}" for k, v in CLASH.items()]) if clash else df

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, a very long text, repeated rows, an id with two texts."""
    long_text = words(1, 60_000, 5_000)
    return [
        (1, words(2, 40), "a"),
        (2, None, "a"),
        (3, "", None),
        (4, " \n\t ", "b"),
        (5, long_text, None),
        (6, words(2, 40), "b"),
        (6, words(2, 40), "b"),
        (7, "one", "a"),
        (7, "two words", "c"),
        (None, words(3, 30), "a"),
        (None, None, None),
        (8, "émigré ÀÉ 日本語 😀 text", "a"),
    ]
