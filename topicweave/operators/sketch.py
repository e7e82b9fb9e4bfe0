"""A count-min prefilter of the word shuffle.

The sketch counts documents by ``rows`` hashes of their words into ``width``
counters each.  A word's true document frequency is never above its smallest
counter, so a word with a counter below the band's lower end provably misses
the band: its tokens are dropped in the map tasks.  Survivors are counted
exactly, so the band's rows do not depend on the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.functions.constants import MAX_DF, MIN_DF
from topicweave.operators.features import counted_words, df_band

WIDTH = 1 << 14
ROWS = 2


def _cell(word: Column, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), word), F.lit(width)).cast("int")


def frequency_sketch(docs: DataFrame, words_col: str = "cleaned_words", width: int = WIDTH, rows: int = ROWS) -> DataFrame:
    """``row, cell, n``: documents by hashed word, at most ``rows * width`` rows.

    A document counts once a cell, so cells stay small.  Map tasks add up their
    own counts: each sends ``rows * width`` rows at most.
    """
    cells = F.flatten(F.array(*[F.transform(_cells(words_col, r, width), _tagged(r)) for r in range(rows)]))
    opened = docs.select(F.explode_outer(cells).alias("c")).where(F.col("c").isNotNull())
    return opened.groupBy(F.col("c.row").alias("row"), F.col("c.cell").alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def _cells(words_col: str, row: int, width: int) -> Column:
    return F.array_distinct(F.transform(words_col, lambda w: _cell(w, row, width)))


def _tagged(row: int):
    return lambda c: F.struct(F.lit(row).alias("row"), c.alias("cell"))


def merge_sketches(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sketch of both corpora (of one width)."""
    return a.unionByName(b).groupBy("row", "cell").agg(F.sum("n").alias("n"))


def may_reach(words: DataFrame, sketch: DataFrame, least: float, width: int = WIDTH, rows: int = ROWS, word: str = "word") -> DataFrame:
    """Rows of ``words`` whose word's every counter reaches ``least``.

    The broadcast sides are the cells that reach it: ``width`` numbers at most.
    """
    reached = sketch.where(F.col("n") >= least)
    for r in range(rows):
        cells = reached.where(F.col("row") == r).select(F.col("cell").alias("reached_cell"))
        words = words.join(F.broadcast(cells), _cell(F.col(word), r, width) == F.col("reached_cell"), "left_semi")
    return words


def filtered_term_stats(
    docs: DataFrame, n_docs: int, words_col: str = "cleaned_words", min_df: float = MIN_DF, width: int = WIDTH, rows: int = ROWS, sketch: DataFrame | None = None
) -> DataFrame:
    """``word, term_frequency, doc_freq`` of every word that may reach the
    band's lower end; exact for each of them."""
    least = min_df if min_df >= 1.0 else min_df * n_docs
    sketch = frequency_sketch(docs, words_col, width, rows) if sketch is None else sketch
    kept = may_reach(counted_words(docs, words_col), sketch, least, width, rows)
    return kept.groupBy("word").agg(F.sum("n").alias("term_frequency"), F.count(F.lit(1)).alias("doc_freq"))


def filtered_band(docs: DataFrame, n_docs: int, words_col: str = "cleaned_words", min_df: float = MIN_DF, max_df: float = MAX_DF, **options) -> DataFrame:
    """The band's rows (``features.df_band`` of the exact statistics)."""
    return df_band(filtered_term_stats(docs, n_docs, words_col, min_df, **options), n_docs, min_df, max_df)
