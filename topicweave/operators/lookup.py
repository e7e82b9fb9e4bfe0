"""Vocabulary lookups.

The vocabulary is a ``(term_idx, word)`` table
(never a delimiter-joined string, so a word containing a comma cannot shift
ids).  A vocabulary has at most ``vocab_size`` rows (2^18 by default), which
is the proven bound that lets it go to every task: as an array for ids to
words, as the broadcast side of a join for words to ids, whose regrouping is
keyed by the caller's row key, so one task holds at most one row's ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _regroup(exploded: DataFrame, keys: Sequence[str], value: str, out_col: str) -> DataFrame:
    """Collect ``value`` back per key in ``_pos`` order (skipping misses)."""
    return exploded.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_pos", value))).alias("_v")
    ).select(
        *keys,
        F.transform(
            F.filter("_v", lambda x: x["_pos"].isNotNull() & x[value].isNotNull()),
            lambda x: x[value],
        ).alias(out_col),
    )


def vocabulary_array(vocab_df: DataFrame) -> Column:
    """The vocabulary's words by term id, as one array: a scalar subquery that
    Spark evaluates once and hands to every task.  Its size is the
    vocabulary's, whose bound is ``vocab_size`` (2^18 by default)."""
    ordered = F.array_sort(F.collect_list(F.struct("term_idx", "word")))
    pairs = vocab_df.select("term_idx", "word").agg(ordered.alias("v"))
    last = F.element_at("v", -1)["term_idx"]
    by_id = F.map_from_entries("v")
    dense = F.transform(F.sequence(F.lit(0), last), lambda i: F.element_at(by_id, i))
    # ids count from 0 without gaps: the usual case needs no map
    whole = (F.size("v") == last + 1) & (F.element_at("v", 1)["term_idx"] == 0)
    return pairs.select(
        F.when(F.size("v") == 0, F.array().cast("array<string>"))
        .when(whole, F.transform("v", lambda x: x["word"]))
        .otherwise(dense)
        .alias("words")
    ).scalar()


def ids_to_words(
    df: DataFrame,
    ids_col: str,
    vocab_df: DataFrame,
    keys: Sequence[str],
    out_col: str = "words",
) -> DataFrame:
    """``keys, out_col`` with every term id replaced by its word.

    Order and length are kept; an id outside the vocabulary (or a null id)
    gives a null word, so words stay aligned with a parallel weights array.
    Rows with an empty or null id list keep an empty list.  Each row is
    translated where it is: no exchange.
    """
    rows = df.select(*keys, F.col(ids_col).alias("_ids"), vocabulary_array(vocab_df).alias("_words"))
    empty = F.array().cast("array<string>")
    named = F.transform("_ids", lambda i: F.when(i >= 0, F.get(F.col("_words"), i.cast("int"))))
    return rows.select(*keys, F.coalesce(named, empty).alias(out_col))


def words_to_ids(
    df: DataFrame,
    words_col: str,
    vocab_df: DataFrame,
    keys: Sequence[str],
    out_col: str = "term_ids",
) -> DataFrame:
    """Inverse lookup: ``keys, out_col`` = term ids of the in-vocabulary words,
    in token order."""
    ex = df.select(*keys, F.posexplode_outer(words_col).alias("_pos", "word"))
    joined = ex.join(F.broadcast(vocab_df.select("word", "term_idx")), "word", "left")
    return _regroup(joined, keys, "term_idx", out_col)
