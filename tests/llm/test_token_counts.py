from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from litscope.llm import token_counts as K
from litscope.llm.queries import vocabulary

PATH = vocabulary()
SIGNS = st.text(alphabet=" \n\tab'lrevé1,.!　x", max_size=700)


def cut(text):
    return K._cut(K._split.findall(text), K._counts(PATH))


@settings(max_examples=300, deadline=None)
@given(SIGNS, st.lists(st.tuples(st.integers(0, 700), st.integers(0, 60), st.text(alphabet=" \nab'l1é.", max_size=90)), max_size=4))
def test_edited_counts_equal_full_counts(text, edits):
    K.SEGMENT, kept = 4, K.SEGMENT
    try:
        tree = K.Tree(*cut(text))
        for start, length, new in edits:
            start = min(start, len(text))
            text, tree, _ = K.edit(text, tree, start, min(len(text), start + length), new, K._counts(PATH))
            assert tree.tokens[1] == K.full_count(text, PATH)
            assert tree.chars[1] == len(text)
    finally:
        K.SEGMENT = kept


def test_only_the_touched_region_is_encoded():
    text = "some words of a long text, " * 4000
    tree = K.Tree(*cut(text))
    _, tree, encoded = K.edit(text, tree, 50_000, 50_004, "other words", K._counts(PATH))
    assert encoded < 2000


ROWS = [
    (1, "mail ann@example.org now", [(5, 20, "[email]")]),
    (2, None, [(0, 0, "new")]),
    (3, None, None),
    (4, "", []),
    (5, "abc def", [(0, 3, "x"), (2, 5, "y"), (90, 95, "!"), (None, 1, "z"), (4, 4, None)]),
    (5, "abc def", [(0, 3, "x"), (2, 5, "y"), (90, 95, "!"), (None, 1, "z"), (4, 4, None)]),
]
SCHEMA = f"doc_id bigint, text string, edits {K.EDITS}"


def test_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("n_tokens", F.lit("clashes"))
    rows = K.apply_edits(K.segment_trees(docs, PATH), PATH).select("doc_id", "text", "n_tokens", "encoded_chars").collect()
    assert [(r[0], r[1]) for r in rows] == [(1, "mail [email] now"), (2, "new"), (3, None), (4, ""), (5, "x def!"), (5, "x def!")]
    for r in rows:
        assert r["n_tokens"] == K.full_count(r["text"], PATH)
    assert K.apply_edits(K.segment_trees(docs.limit(0), PATH), PATH).count() == 0


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "x" * 50_000 + " y" * 50_000, [(10, 20, ""), (99_000, 99_001, "q")])], "doc_id bigint, text string, edits " + K.EDITS)
    row = K.apply_edits(K.segment_trees(docs, PATH), PATH).first()
    assert row["n_tokens"] == K.full_count(row["text"], PATH)


@pytest.mark.parametrize("pieces", [0, 1, 63, 64, 65])
def test_segment_sizes(pieces):
    chars, tokens = cut(" a" * pieces)
    assert sum(chars) == 2 * pieces and sum(tokens) == pieces
