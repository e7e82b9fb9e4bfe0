"""Column functions: the reference's three unit cases plus edge cases."""

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from topicweave.functions.arrays import (
    dist_array,
    dist_sum,
    is_complete,
    merge_sets,
    score_topic,
    vector_entries,
)
from topicweave.functions.constants import ENGLISH_STOP_WORDS, MARKUP_PUNCT_DIGIT_PATTERN
from topicweave.functions.text import clean_markup, clean_tokens, ngrams, remove_stop_words, tokenize
from topicweave.operators.lookup import ids_to_words


def test_merge_lists(spark):
    df = spark.createDataFrame([([["a", "b"], ["b", "c"]],), ([["a", "b"]],)], ["list_set"])
    res = df.select(merge_sets("list_set").alias("m")).collect()
    assert len(res) == 2
    assert len(res[0]["m"]) == 3
    assert sorted(res[0]["m"]) == ["a", "b", "c"]


def test_merge_lists_nulls(spark):
    df = spark.createDataFrame(
        [([["a", None], ["b"]],), ([None, ["x"]],)], "list_set array<array<string>>"
    )
    res = [r["m"] for r in df.select(merge_sets("list_set").alias("m")).collect()]
    assert res[0] == [None, "a", "b"]  # a null element is a value of the union
    assert res[1] == ["x"]  # a null sub-list is skipped


def test_ids_to_words(spark):
    vocab = spark.createDataFrame(
        [(i, w) for i, w in enumerate("a,b,c,d".split(","))], "term_idx int, word string"
    )
    df = spark.createDataFrame([(1, [2, 1, 0])], "k int, word_index array<int>")
    res = ids_to_words(df, "word_index", vocab, ["k"]).collect()
    assert len(res) == 1
    assert res[0]["words"] == ["c", "b", "a"]


def test_ids_to_words_comma_and_empty(spark):
    vocab = spark.createDataFrame([(0, "a,b"), (1, "c")], "term_idx int, word string")
    df = spark.createDataFrame([(1, [1, 0]), (2, []), (3, None)], "k int, ids array<int>")
    res = {r["k"]: r["words"] for r in ids_to_words(df, "ids", vocab, ["k"]).collect()}
    assert res == {1: ["c", "a,b"], 2: [], 3: []}


def test_get_topic(spark):
    df = spark.createDataFrame([(Vectors.dense([0.1, 0.2, 0.3, 0.4]),)], ["score_list"])
    r = df.select(score_topic(dist_array("score_list")).alias("st")).first()["st"]
    assert r["topic"] == 3
    assert abs(r["score"] - 0.4) < 1e-7


def test_argmax_ties_and_zero(spark):
    df = spark.createDataFrame(
        [([0.5, 0.5, 0.0],), ([0.0, 0.0, 0.0],), ([0.1, 0.3, 0.3],)], "d array<double>"
    )
    res = [tuple(r["st"]) for r in df.select(score_topic("d").alias("st")).collect()]
    assert res == [(0.5, 0), (0.0, 0), (0.30000001192092896, 1)]


def test_dist_sum_and_complete(spark):
    df = spark.createDataFrame([([0.25, 0.75],), ([0.0, 0.0],), ([0.1, 0.2, 0.7],)], "d array<double>")
    rows = df.select(dist_sum("d").alias("s"), is_complete("d").alias("c")).collect()
    assert [r["c"] for r in rows] == [True, False, True]


def test_clean_markup_cases(spark):
    cases = [
        ("foo<br>bar", "foobar"),
        ("anti-aging", "antiaging"),
        ("<a\nhref>x", "<a\nhref>x"),  # a tag does not cross a newline
        ("it's #1 + [ok]", "it's # + [ok]"),  # ' # + [ ] survive
        ('a\\b/c"d_e(f)g:h;i,j.k!l?m*n•o|p&q$r%s', "abcdefghijklmnopqrs"),
        ("price 100%", "price "),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], ["t"])
    got = [r[0] for r in df.select(clean_markup("t")).collect()]
    assert got == [b for _, b in cases]
    spaced = df.select(clean_markup("t", " ")).first()[0]
    assert spaced == "foo bar"


def test_tokenize_edges(spark):
    df = spark.createDataFrame(
        [(None,), ("",), ("the and of",), ("...!!!",), ("Hello\x0bWorld X  y",)], "t string"
    )
    got = [r[0] for r in df.select(clean_tokens("t")).collect()]
    assert got[0] == [] and got[1] == [] and got[2] == [] and got[3] == []
    # \x0B splits (Java \s), a non-breaking space does not
    assert got[4] == ["hello", "world x", "y"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(ngrams("t", 2)).collect()]
    assert got == [["a b", "b c"], [], []]
    assert df.select(ngrams("t", 1)).first()[0] == ["a", "b", "c"]


def test_native_tokens_equal_ml_stages(spark):
    """The native expressions give the same tokens as RegexTokenizer +
    StopWordsRemover on the whole sf0.01 document table."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    cleaned = docs.select("doc_id", F.regexp_replace("text", MARKUP_PUNCT_DIGIT_PATTERN, "").alias("d"))
    ml = RegexTokenizer(inputCol="d", outputCol="w").transform(cleaned)
    ml = StopWordsRemover(inputCol="w", outputCol="cw").transform(ml)
    native = docs.select("doc_id", clean_tokens("text").alias("nw"))
    diff = ml.join(native, "doc_id").where(F.col("cw") != F.col("nw")).count()
    assert diff == 0


def test_stop_words_list_matches_spark():
    assert len(ENGLISH_STOP_WORDS) == 181
    assert list(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS


def test_remove_stop_words_case(spark):
    df = spark.createDataFrame([(["The", "cat", "AND", "dog"],)], "t array<string>")
    assert df.select(remove_stop_words("t")).first()[0] == ["cat", "dog"]
    assert df.select(remove_stop_words("t", case_sensitive=True)).first()[0] == [
        "The", "cat", "AND", "dog"
    ]


def test_vector_entries(spark):
    df = spark.createDataFrame(
        [(1, Vectors.sparse(5, [1, 3], [0.5, 2.0])), (2, Vectors.dense([0.0, 0.2]))], ["id", "v"]
    )
    got = {r["id"]: [tuple(e) for e in r["e"]] for r in df.select("id", vector_entries("v").alias("e")).collect()}
    assert got == {1: [(1, 0.5), (3, 2.0)], 2: [(1, 0.2)]}


def test_tokenize_min_length(spark):
    df = spark.createDataFrame([("a bb ccc",)], ["t"])
    assert df.select(tokenize("t", 2)).first()[0] == ["bb", "ccc"]


# --- property test: native tokens equal a plain-Python model of the rules ---

import re as _re

from hypothesis import given, settings
from hypothesis import strategies as st

_ALPHABET = "abcXYZ éÉüß019 \t\n\x0b\f-_/\\\"():;,.!?*•|&$%'#+<>[]"
_PY_PATTERN = _re.compile(MARKUP_PUNCT_DIGIT_PATTERN)
_STOP = set(ENGLISH_STOP_WORDS)


def _py_tokens(text):
    cleaned = _PY_PATTERN.sub("", text).lower()
    return [t for t in _re.split("[ \t\n\x0b\f\r]+", cleaned) if len(t) >= 1 and t not in _STOP]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=60), min_size=1, max_size=20))
def test_tokens_match_python_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["w"] for r in df.select("i", clean_tokens("t").alias("w")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _py_tokens(t), (t, got[i])
