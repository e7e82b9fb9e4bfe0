"""TF-IDF features (A13, A14, M1-M4): determinism, equality to Spark's stages."""

import math

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from topicweave.functions.arrays import vector_entries
from topicweave.functions.text import clean_tokens
from topicweave.operators.features import fit_features, term_stats, tfidf_long, word_counts


def _tokens(spark, sf=SF_SMALL):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", clean_tokens("text").alias("cleaned_words"))


def _entries(model, toks):
    out = model.transform(toks).select("doc_id", F.explode(vector_entries("features")).alias("e"))
    vocab = model.vocab_df.select(F.col("term_idx").alias("idx"), "word")
    rows = out.select("doc_id", "e.idx", "e.value").join(vocab, "idx").collect()
    return {(r["doc_id"], r["word"]): r["value"] for r in rows}


def test_vector_equals_long_form(spark):
    toks = _tokens(spark)
    model = fit_features(toks)
    vec = _entries(model, toks)
    long = {(r["doc_id"], r["word"]): r["tfidf"] for r in tfidf_long(toks, "doc_id").collect()}
    assert vec.keys() == long.keys()
    assert max(abs(vec[k] - long[k]) for k in vec) == 0.0


def test_matches_spark_countvectorizer_and_idf(spark):
    toks = _tokens(spark)
    ours = fit_features(toks)
    cv = CountVectorizer(inputCol="cleaned_words", outputCol="raw", minDF=0.01, maxDF=0.3).fit(toks)
    assert set(cv.vocabulary) == set(ours.vocabulary)
    idf = IDF(inputCol="raw", outputCol="f").fit(cv.transform(toks))
    theirs = dict(zip(cv.vocabulary, idf.idf.toArray()))
    v = ours.vocab_df.collect()
    assert all(abs(theirs[r["word"]] - r["idf"]) <= 1e-12 * abs(r["idf"]) for r in v)


def test_vocabulary_independent_of_layout(spark):
    toks = _tokens(spark, SF_MID)
    a = fit_features(toks).vocabulary
    b = fit_features(toks.repartition(7)).vocabulary
    c = fit_features(toks.repartition(3, "doc_id").sortWithinPartitions(F.rand(1))).vocabulary
    assert a == b == c


def test_vocab_order_rule(spark):
    toks = _tokens(spark, SF_MID)
    m = fit_features(toks)
    rows = sorted(m.vocab_df.collect(), key=lambda r: r["term_idx"])
    keys = [(-r["term_frequency"], r["word"]) for r in rows]
    assert keys == sorted(keys)
    n = m.n_docs
    assert all(0.01 * n <= r["doc_freq"] <= 0.3 * n for r in rows)
    assert all(abs(r["idf"] - math.log((n + 1.0) / (r["doc_freq"] + 1.0))) <= 1e-12 for r in rows)


def test_term_stats_counts(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (2, ["b"]), (3, []), (4, ["c", "a"])], "doc_id int, cleaned_words array<string>"
    )
    s = {r["word"]: (r["term_frequency"], r["doc_freq"]) for r in term_stats(df).collect()}
    assert s == {"a": (3, 2), "b": (2, 2), "c": (1, 1)}
    w = {r["word"]: r["term_frequency"] for r in word_counts(df).collect()}
    assert w == {"a": 3, "b": 2, "c": 1}


def test_empty_vocabulary_raises(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (3, ["c"])], "doc_id int, cleaned_words array<string>")
    with pytest.raises(ValueError, match="empty vocabulary"):
        fit_features(df, min_df=0.5, max_df=0.6)


def test_vocab_size_cap(spark):
    toks = _tokens(spark)
    m = fit_features(toks, vocab_size=50)
    assert len(m.vocabulary) == 50 and m.vocab_df.count() == 50


def test_tokenizing_evaluated_once_per_row(spark):
    """No filter inferred from the explode re-runs the cleaning regex."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    toks = docs.select("doc_id", clean_tokens("text").alias("cleaned_words"))
    for df in (term_stats(toks), word_counts(toks), tfidf_long(toks, "doc_id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        per_scan = plan.count("regexp_replace")
        scans = plan.count("FileScan") or plan.count("Scan parquet")
        assert per_scan <= scans, plan


def test_vectors_equal_stock_ml_pipeline(spark):
    """Every (document, word) TF-IDF weight equals the stock ML pipeline's
    (tokenizer -> stop words -> count vectorizer -> IDF) on sf0.01; only the
    order of equal-count terms in the vocabulary may differ."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import RegexTokenizer, StopWordsRemover

    from topicweave.functions.constants import MARKUP_PUNCT_DIGIT_PATTERN

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    cleaned = docs.select("doc_id", F.regexp_replace("text", MARKUP_PUNCT_DIGIT_PATTERN, "").alias("d"))
    stock = Pipeline(stages=[
        RegexTokenizer(inputCol="d", outputCol="w"),
        StopWordsRemover(inputCol="w", outputCol="cw"),
        CountVectorizer(inputCol="cw", outputCol="raw", maxDF=0.3, minDF=0.01),
        IDF(inputCol="raw", outputCol="features"),
    ]).fit(cleaned)
    vocab = stock.stages[2].vocabulary
    theirs = {}
    for r in stock.transform(cleaned).select("doc_id", "features").collect():
        v = r["features"]
        for i, x in zip(v.indices, v.values):
            theirs[(r["doc_id"], vocab[i])] = x
    toks = docs.select("doc_id", clean_tokens("text").alias("cleaned_words"))
    ours = _entries(fit_features(toks), toks)
    assert ours.keys() == theirs.keys()
    assert max(abs(ours[k] - theirs[k]) / abs(theirs[k]) for k in ours) <= 1e-12


# --- property tests: vocabulary statistics and lookups vs plain Python -------

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from topicweave.operators.lookup import ids_to_words, words_to_ids

_docs = st.lists(st.lists(st.sampled_from(list("abcdefgh")), max_size=8), min_size=1, max_size=10)


@settings(max_examples=20, deadline=None)
@given(_docs)
def test_term_stats_match_counter(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, cleaned_words array<string>")
    got = {r["word"]: (r["term_frequency"], r["doc_freq"]) for r in term_stats(df).collect()}
    tf = Counter(w for d in docs for w in d)
    dfreq = Counter(w for d in docs for w in set(d))
    assert got == {w: (tf[w], dfreq[w]) for w in tf}


@settings(max_examples=15, deadline=None)
@given(_docs)
def test_lookup_round_trip(spark, docs):
    vocab = spark.createDataFrame(
        [(i, w) for i, w in enumerate("hgfedc")], "term_idx int, word string"
    )
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, cleaned_words array<string>")
    ids = words_to_ids(df, "cleaned_words", vocab, ["doc_id"])
    back = {r["doc_id"]: r["words"] for r in ids_to_words(ids, "term_ids", vocab, ["doc_id"]).collect()}
    assert back == {i: [w for w in d if w in "hgfedc"] for i, d in enumerate(docs)}


def test_dealing_out_is_asked_for(spark):
    from topicweave.session import INPUT_PARTITIONS, dealt

    narrow = spark.range(0, 1000, numPartitions=1)
    before = spark.conf.get(INPUT_PARTITIONS, None)
    try:
        spark.conf.unset(INPUT_PARTITIONS)
        assert dealt(narrow) is narrow
        spark.conf.set(INPUT_PARTITIONS, "5")
        assert "RoundRobinPartitioning(5)" in dealt(narrow)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(INPUT_PARTITIONS)
        if before:
            spark.conf.set(INPUT_PARTITIONS, before)


def test_nothing_probes_an_rdd():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "topicweave"
    for part in ("functions", "operators", "plans", "sources"):
        for f in (root / part).glob("*.py"):
            assert ".rdd" not in f.read_text(), f


def test_vocabulary_overflow_is_an_error(spark, monkeypatch):
    from topicweave.operators import features as feats

    toks = _tokens(spark)
    monkeypatch.setattr(feats, "DEFAULT_VOCAB_SIZE", 20)
    with pytest.raises(feats.VocabularyOverflow):
        fit_features(toks)
    with pytest.raises(feats.VocabularyOverflow):
        tfidf_long(toks, "doc_id")
    assert len(fit_features(toks, vocab_size=20).vocabulary) == 20


def test_unknown_ids_stay_in_place(spark):
    vocab = spark.createDataFrame([(0, "a"), (1, "b")], "term_idx int, word string")
    df = spark.createDataFrame([(1, [1, 7, 0]), (2, [-1, None]), (3, []), (4, None)], "k int, ids array<int>")
    got = {r["k"]: r["words"] for r in ids_to_words(df, "ids", vocab, ["k"]).collect()}
    assert got == {1: ["b", None, "a"], 2: [None, None], 3: [], 4: []}
    gappy = spark.createDataFrame([(2, "c"), (0, "a")], "term_idx int, word string")
    assert ids_to_words(df.where("k = 1"), "ids", gappy, ["k"]).first()["words"] == [None, None, "a"]
    plan = ids_to_words(df, "ids", vocab, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Join" not in plan


def test_vocabulary_is_the_broadcast_side(spark):
    from topicweave.plans.catalog import q_tfidf_vector_unpacked

    plan = q_tfidf_vector_unpacked(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "BuildLeft" not in plan


def test_checkpoint_dir_is_the_sessions(spark):
    from topicweave.session import ensure_checkpoint_dir

    d = ensure_checkpoint_dir(spark)
    assert d and "tw-test-ckpt-" in d  # the folder the session names, not a new one
