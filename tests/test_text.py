from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from litscope.functions.stem import porter
from litscope.functions.text import _PART, WORD, Analysis, analyse, candidate_phrases, words
from litscope.operators import postings as P


@pytest.mark.parametrize(
    "text, expected",
    [
        ("The U.S.A and don't", ["the", "u.s.a", "and", "don't"]),
        ("1,000 v1.2 x:y", ["1,000", "v1.2", "x:y"]),
        ("a.1 k-means", ["a", "1", "k", "means"]),
        ("conf/aaai/AmirSS15", ["conf", "aaai", "amirss15"]),
        ("1." * 100_000 + "1", ["1." * 100_000 + "1"]),
        ("東京タワーへ行く", ["東", "京", "タワー", "へ", "行", "く"]),
        ("ﾃﾚﾋﾞ x東y", ["ﾃﾚﾋﾞ", "x", "東", "y"]),
        ("한국어 말 ไทยง่าย", ["한국어", "말", "ไทยง่าย"]),
        ("か\u3099 が.a 漢:b", ["か\u3099", "が", "a", "漢", "b"]),
        ("\U0001f469\u200d\U0001f4bb ok\U0001f44d\U0001f3fd \U0001f1e9\U0001f1ea\U0001f1eb\U0001f1f7", ["\U0001f469\u200d\U0001f4bb", "ok", "\U0001f44d\U0001f3fd", "\U0001f1e9\U0001f1ea", "\U0001f1eb\U0001f1f7"]),
        ("na\u0308ive can't 3.14 a_b", ["na\u0308ive", "can't", "3.14", "a_b"]),
        ("a.b.c. d:e: x..y 1,2,x", ["a.b.c", "d:e", "x", "y", "1,2", "x"]),
    ],
)
def test_words(spark, text, expected):
    assert spark.range(1).select(words(F.lit(text), WORD)).first()[0] == expected


# Word pairs from the paper that describes the algorithm.
@pytest.mark.parametrize(
    "word, stem",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"),
        ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"),
        ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
        ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"), ("falling", "fall"),
        ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"), ("filing", "file"),
        ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"),
        ("rational", "ration"), ("valenci", "valenc"), ("digitizer", "digit"),
        ("radicalli", "radic"), ("vietnamization", "vietnam"), ("operator", "oper"),
        ("feudalism", "feudal"), ("decisiveness", "decis"), ("hopefulness", "hope"),
        ("sensitiviti", "sensit"), ("sensibiliti", "sensibl"), ("triplicate", "triplic"),
        ("formative", "form"), ("electrical", "electr"), ("goodness", "good"),
        ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("airliner", "airlin"),
        ("adjustable", "adjust"), ("irritant", "irrit"), ("replacement", "replac"),
        ("adoption", "adopt"), ("communism", "commun"), ("activate", "activ"), ("bowdlerize", "bowdler"),
        ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"),
        ("roll", "roll"), ("icse", "ics"), ("by", "by"), ("yyy", "yyi"),
    ],
)
def test_porter(word, stem):
    assert porter(word) == stem


def analysed(spark, text, analysis=Analysis(), field="title"):
    df = spark.createDataFrame([(field, text)], "field string, text string")
    return [(t.term, t.pos) for t in analyse(df, "text", analysis).first()["terms"]]


def test_stop_words_leave_gaps_and_stems_follow(spark):
    assert analysed(spark, "The Internet of Things' end") == [("internet", 1), ("thing", 3), ("end", 4)]
    assert analysed(spark, "Moore's laws") == [("moor", 0), ("law", 1)]


def test_simple_fields_are_only_lower_cased(spark):
    analysis = Analysis(simple_fields=("author",))
    assert analysed(spark, "The Running Man", analysis, "author") == [("the", 0), ("running", 1), ("man", 2)]
    assert analysed(spark, "The Running Man", analysis) == [("run", 1), ("man", 2)]


def test_values_of_a_list_field_adjoin(spark):
    corpus = spark.createDataFrame([(1, 2000, ["A B", "C D"])], "doc_id long, year int, author array<string>")
    rows = P.occurrences(P.document_terms(corpus, ["author"], Analysis()))
    # "a" is a stop word, and its place stays open.
    assert sorted((r.term, r.pos) for r in rows.collect()) == [("b", 1), ("c", 2), ("d", 3)]


def test_postings_equal_a_plain_group_by(spark):
    texts = [(1, 2000, "red blue red"), (2, 2001, ""), (3, 2001, "the"), (4, 2002, "blue"), (5, 2002, None)]
    corpus = spark.createDataFrame(texts, "doc_id long, year int, title string").repartition(3)
    terms = P.document_terms(corpus, ["title"], Analysis())
    ours = P.postings(P.document_postings(terms)).select("term", "doc_id", "tf", "positions", "length")
    plain = P.occurrences(terms).groupBy("term", "doc_id", "length").agg(
        F.count("*").cast("int").alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions")
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.select(*ours.columns).collect()))
    assert ours.count() == 3


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Deep neural networks for graph learning", ["deep neural networks", "graph learning"]),
        ("one two three four five", []),
        ("Semi-supervised learning", ["supervised learning"]),
        ("End (see). Next step", ["see ). next step"]),
        ("alpha ). beta", ["alpha ). beta"]),
        ("single", []),
        ("red || blue", ["red || blue"]),
    ],
)
def test_candidate_phrases(spark, text, expected):
    got = spark.range(1).select(candidate_phrases(F.lit(text))).first()[0]
    assert got == expected


def test_terms_are_made_in_few_passes(spark):
    """A text takes one pass over its words, as it has a possessive or not, and one over its stop words."""
    rows = [("title", "the cat's paws and Ann's ta'sk"), ("title", "of plain words"), ("title", "漢'タ’s x’s's"), ("title", None)]
    df = analyse(spark.createDataFrame(rows, "field string, text string"), "text", Analysis(stem=False))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == 2 and plan.count("Generate explode") == 2
    found = {r.text: r.terms and [(t.term, t.pos) for t in r.terms] for r in df.collect()}
    assert found == {
        rows[0][1]: [("cat", 1), ("paws", 2), ("ann", 4), ("ta'sk", 5)],
        rows[1][1]: [("plain", 1), ("words", 2)],
        rows[2][1]: [("漢", 0), ("タ", 1), ("s", 2), ("x’s", 3)],
        None: None,
    }


def test_quick_forms_of_words_change_no_word(spark):
    """The forms for ranges of signs find what the general ones find, whatever stands beside them."""
    general = "(?:" + WORD[WORD.index(_PART + "+") :]
    signs = list("az9_ '’.,:é\u0301漢\u9ff0かカー\u3099ﾞไ가\u200d\ufe0f") + ["\U0001f44d", "\U0001f1e9"]
    texts = [a + b + c for a in signs for b in signs for c in signs]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", words(F.col("t"), WORD).alias("quick"), words(F.col("t"), general).alias("slow"))
    assert general != WORD and both.where("quick <> slow").count() == 0


def test_grouping_holds_few_terms_at_once(monkeypatch):
    """A batch of many documents is grouped piece by piece, and each piece handed on."""
    import pyarrow as pa

    from litscope.functions import grouping

    monkeypatch.setattr(grouping, "AT_ONCE", 4)
    texts = [["b", "a", "b"], [], ["c"], None, ["d"] * 9, ["a", "b"], ["b"]]
    kind = pa.list_(pa.struct([("term", pa.string()), ("pos", pa.int32())]))
    rows = [None if t is None else [{"term": w, "pos": i} for i, w in enumerate(t)] for t in texts]
    for cut in (0, 2):
        pieces = list(grouping.group_terms.func(iter([pa.array(rows, kind)[cut:]])))
        assert len(pieces) > 2 and sum(map(len, pieces)) == len(rows) - cut
        found = [[(p["term"], p["tf"], p["positions"]) for p in row or []] for piece in pieces for row in piece.to_pylist()]
        expected = [[(w, t.count(w), [i for i, x in enumerate(t) if x == w]) for w in dict.fromkeys(t or [])] for t in texts]
        assert list(map(sorted, found)) == list(map(sorted, expected[cut:]))
