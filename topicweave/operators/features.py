"""TF-IDF features with a reproducible vocabulary.

The vocabulary is computed with one DataFrame aggregation over
``(word) -> (term count, document count)``; documents are counted with the
sorted-array trick (first occurrence in the sorted token list), so there is
a single shuffle keyed by word, pre-aggregated map-side.  The band filter and
the ``(count desc, word asc)`` order make term ids independent of row layout.
Only the capped vocabulary (at most ``vocab_size`` rows) reaches the driver;
it *is* the model, like Spark's own ``CountVectorizer`` vocabulary.

Vectors are then produced by ``CountVectorizerModel`` (counts) and an
``ElementwiseProduct`` with the IDF weights ``ln((n+1)/(df+1))`` computed from
the same document counts: Spark's ``IDF`` formula (equal to within 1e-12
relative, the log being evaluated by the JVM expression the long form uses)
without a second pass over the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicweave.functions.constants import DEFAULT_VOCAB_SIZE, ENGLISH_STOP_WORDS, MAX_DF, MIN_DF
from topicweave.functions.text import clean_markup, clean_tokens
from topicweave.session import cut_lineage
from topicweave.sources.io import read_table, write_table


def with_clean_description(items: DataFrame, col: str = "description", replacement: str = "") -> DataFrame:
    """Replace the description with its F1-cleaned text."""
    return items.withColumn(col, clean_markup(col, replacement))


def with_tokens(
    items: DataFrame,
    text_col: str = "description",
    out_col: str = "cleaned_words",
    replacement: str = "",
    ngram: int | None = None,
    stop_words=ENGLISH_STOP_WORDS,
) -> DataFrame:
    """F1-F4 as one projection: ``out_col`` holds the cleaned token list."""
    return items.withColumn(out_col, clean_tokens(text_col, replacement, stop_words, ngram))


def explode_words(docs: DataFrame, words_col: str, *keep: str, with_pos: bool = False) -> DataFrame:
    """one row per token (``keep`` columns carried along).

    Written as an *outer* explode plus a filter on the generated column: a
    plain explode makes Catalyst infer ``size(tokens) > 0`` and push it below
    the projection (and below a repartition), which evaluates the whole
    cleaning/tokenizing expression twice per row.
    """
    if with_pos:
        gen = F.posexplode_outer(words_col).alias("_pos", "word")
    else:
        gen = F.explode_outer(words_col).alias("word")
    return docs.select(*keep, gen).where(F.col("word").isNotNull())


def word_counts(docs: DataFrame, words_col: str = "cleaned_words") -> DataFrame:
    """Corpus count of every word (``explode`` + ``groupBy``)."""
    return (
        explode_words(docs, words_col)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("term_frequency"))
    )


def sorted_words(words: Column) -> Column:
    """A word list in order, nulls last.  ``array_sort`` runs its comparison as
    an expression, for each pair of words; ``sort_array`` compares them as they
    are and puts nulls first, so the first word tells whether there are any."""
    ordered = F.sort_array(words)
    return F.when(F.get(ordered, F.lit(0)).isNull() & (F.size(ordered) > 0), F.array_sort(words)).otherwise(ordered)


def term_stats(docs: DataFrame, words_col: str = "cleaned_words") -> DataFrame:
    """A8 + A13: ``word, term_frequency, doc_freq`` in one aggregation.

    A row gives its list and, beside it, the list's distinct words, so no
    per-(doc, word) shuffle is needed: the first counts tokens, the second
    documents.  A null is no word of the band: it has no document count.
    """
    lists = docs.select(F.posexplode_outer(F.array(F.col(words_col), F.array_distinct(words_col))).alias("_d", "_w"))
    exploded = lists.select("_d", F.explode("_w").alias("word"))
    once = F.when(F.col("word").isNotNull(), F.col("_d").cast("long"))
    return exploded.groupBy("word").agg(F.sum(F.lit(1).cast("long") - F.col("_d")).alias("term_frequency"), F.sum(once).alias("doc_freq"))


def counted_words(docs: DataFrame, words_col: str, *keep: str) -> DataFrame:
    """``keep, word, n``: each document's distinct words with their counts,
    made inside its row from the runs of the sorted list (no shuffle).

    Every step is a projection of its own: an array that a lambda refers to
    would be made again for each element otherwise.
    """
    ordered = docs.select(*keep, sorted_words(F.col(words_col)).alias("_o"))
    last = F.size("_o") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.get(F.col("_o"), i) != F.get(F.col("_o"), i + 1)))
    ended = ordered.select(*keep, "_o", F.when(F.size("_o") > 0, ends).otherwise(F.array().cast("array<int>")).alias("_e"))

    def run(end, k):
        before = F.when(k == 0, F.lit(-1)).otherwise(F.get(F.col("_e"), k - 1))
        return F.struct(F.get(F.col("_o"), end).alias("word"), (end - before).alias("n"))

    opened = ended.select(*keep, F.explode_outer(F.transform("_e", run)).alias("_t"))
    return opened.where(F.col("_t").isNotNull()).select(*keep, "_t.word", "_t.n")


def df_band(stats: DataFrame, n_docs: int, min_df: float = MIN_DF, max_df: float = MAX_DF) -> DataFrame:
    """Keep terms with ``min_df <= df <= max_df`` (fractions of ``n_docs``
    below 1.0, absolute counts otherwise), like ``CountVectorizer``."""
    lo = min_df if min_df >= 1.0 else min_df * n_docs
    hi = max_df if max_df >= 1.0 else max_df * n_docs
    return stats.where((F.col("doc_freq") >= F.lit(lo)) & (F.col("doc_freq") <= F.lit(hi)))


class VocabularyOverflow(ValueError):
    """More terms in the document-frequency band than the vocabulary holds."""


def vocabulary_rows(band: DataFrame, vocab_size: int | None) -> list:
    """T5: the band's terms, most frequent first (ties by word); at most the
    vocabulary's bound of rows.

    A ``vocab_size`` that the caller gives cuts the list, as asked.  Without
    one the default bound holds, and a band beyond it is an error, never a
    silent cut.
    """
    ordered = band.orderBy(F.col("term_frequency").desc(), F.col("word").asc())
    if vocab_size is not None:
        return ordered.limit(vocab_size).collect()
    rows = ordered.limit(DEFAULT_VOCAB_SIZE + 1).collect()
    if len(rows) > DEFAULT_VOCAB_SIZE:
        raise VocabularyOverflow(
            f"more than {DEFAULT_VOCAB_SIZE} terms lie in the document-frequency band; "
            "narrow the band or pass vocab_size to keep the most frequent"
        )
    return rows


def idf_column(n_docs: int, df_col: str = "doc_freq") -> F.Column:
    return F.log(F.lit(n_docs + 1.0) / (F.col(df_col) + F.lit(1.0)))


@dataclass
class FeatureModel:
    """Fitted feature stage: vocabulary table + vector pipeline."""

    vocabulary: list[str]
    vocab_df: DataFrame  # term_idx int, word string, doc_freq long, term_frequency long, idf double
    pipeline: PipelineModel  # counts -> tf-idf
    n_docs: int
    words_col: str = "cleaned_words"
    features_col: str = "features"

    def transform(self, docs: DataFrame) -> DataFrame:
        """Add the TF-IDF ``features`` vector (tokens must already exist)."""
        return self.pipeline.transform(docs).drop("_raw_counts")


VOCAB_SCHEMA = T.StructType(
    [
        T.StructField("term_idx", T.IntegerType(), False),
        T.StructField("word", T.StringType(), False),
        T.StructField("doc_freq", T.LongType(), False),
        T.StructField("term_frequency", T.LongType(), False),
        T.StructField("idf", T.DoubleType(), False),
    ]
)


def fit_features(
    docs: DataFrame,
    words_col: str = "cleaned_words",
    features_col: str = "features",
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    vocab_size: int | None = None,
) -> FeatureModel:
    """M1-M4: fit the vocabulary and IDF on ``docs`` (tokens in ``words_col``).

    Two actions: the document count and the ordered vocabulary.
    """
    n_docs = docs.count()
    band = df_band(term_stats(docs, words_col), n_docs, min_df, max_df)
    # bounded by the vocabulary's bound: this is the model
    rows = vocabulary_rows(band.withColumn("idf", idf_column(n_docs)), vocab_size)
    if not rows:
        raise ValueError(
            "empty vocabulary: no term has a document frequency inside "
            f"[{min_df}, {max_df}] of {n_docs} documents"
        )
    vocabulary = [r["word"] for r in rows]
    idf = [r["idf"] for r in rows]  # computed by the same JVM expression as tfidf_long
    spark = docs.sparkSession
    vocab_df = spark.createDataFrame(
        [(i, r["word"], r["doc_freq"], r["term_frequency"], idf[i]) for i, r in enumerate(rows)],
        VOCAB_SCHEMA,
    )
    counts = CountVectorizerModel.from_vocabulary(
        vocabulary, inputCol=words_col, outputCol="_raw_counts"
    )
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(idf), inputCol="_raw_counts", outputCol=features_col
    )
    return FeatureModel(
        vocabulary=vocabulary,
        vocab_df=vocab_df,
        pipeline=PipelineModel(stages=[counts, scale]),
        n_docs=n_docs,
        words_col=words_col,
        features_col=features_col,
    )


def to_tf_idf_features(
    items: DataFrame,
    replacement: str = "",
    ngram: int | None = None,
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    vocab_size: int | None = None,
    tokens_path: str | None = None,
) -> tuple[FeatureModel, DataFrame]:
    """M1: items -> ``(model, product_name, brands, categories, features, cleaned_words)``.

    Tokens are computed once: the fit reads them twice (document count,
    vocabulary) and the transform once more.  ``tokens_path`` names the table
    to keep them in (a run's own folder); without it they are checkpointed.
    """
    tokens = with_tokens(items, replacement=replacement, ngram=ngram).select(
        "product_name", "brands", "categories", "cleaned_words"
    )
    if tokens_path is None:
        tokens = cut_lineage(tokens)
    else:
        tokens = read_table(items.sparkSession, write_table(tokens, tokens_path))
    model = fit_features(tokens, min_df=min_df, max_df=max_df, vocab_size=vocab_size)
    feats = model.transform(tokens).select(
        "product_name", "brands", "categories", "features", "cleaned_words"
    )
    return model, feats


def tfidf_long(
    docs: DataFrame,
    key: str,
    words_col: str = "cleaned_words",
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    vocab_size: int | None = None,
) -> DataFrame:
    """A13/A14 in long form, all in DataFrame ops: ``key, word, tfidf``; one
    row a document.

    A document's words are counted inside its row and joined with the broadcast
    vocabulary (at most ``vocab_size`` rows), so tokens are never shuffled by
    document.
    """
    n_docs = docs.count()
    band = df_band(term_stats(docs, words_col), n_docs, min_df, max_df).withColumn("idf", idf_column(n_docs))
    rows = vocabulary_rows(band, vocab_size)
    vocab = docs.sparkSession.createDataFrame([(r["word"], r["idf"]) for r in rows], "word string, idf double")
    opened = counted_words(docs, words_col, key)
    return opened.join(F.broadcast(vocab), "word").select(key, "word", (F.col("n").cast("double") * F.col("idf")).alias("tfidf"))
