"""Text cleaning and tokenizing as Column expressions.

All functions take and return ``Column`` objects and run inside the JVM: no
Python UDF is involved, so they stay in the same stage as the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicweave.functions.constants import (
    ENGLISH_STOP_WORDS,
    MARKUP_PUNCT_DIGIT_PATTERN,
    WHITESPACE_PATTERN,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_markup(text: str | Column, replacement: str = "") -> Column:
    """delete markup tags, the fixed punctuation set and digits.

    Null stays null.  ``replacement=' '`` keeps word boundaries instead of
    gluing ``foo<br>bar`` into ``foobar``.
    """
    return F.regexp_replace(_col(text), MARKUP_PUNCT_DIGIT_PATTERN, replacement)


def tokenize(text: str | Column, min_token_length: int = 1) -> Column:
    """lower-case, split on whitespace, drop tokens shorter than the minimum.

    Same tokens as ``RegexTokenizer`` with its defaults.  Null text gives an
    empty token list (the ML tokenizer would fail the whole job).
    """
    toks = F.split(F.lower(F.coalesce(_col(text), F.lit(""))), WHITESPACE_PATTERN)
    return F.filter(toks, lambda t: F.length(t) >= F.lit(min_token_length))


def remove_stop_words(
    tokens: str | Column,
    stop_words: Iterable[str] = ENGLISH_STOP_WORDS,
    case_sensitive: bool = False,
) -> Column:
    """drop stop words, keeping token order (``StopWordsRemover``)."""
    words = sorted(stop_words)
    if case_sensitive:
        return F.filter(_col(tokens), lambda t: ~t.isin(words))
    lowered = sorted({w.lower() for w in words})
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(lowered))


def ngrams(tokens: str | Column, n: int = 2) -> Column:
    """space-joined n-grams in order; fewer than ``n`` tokens gives []."""
    if n < 1:
        raise ValueError("n must be >= 1")
    toks = _col(tokens)
    count = F.size(toks) - F.lit(n - 1)
    grams = F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(toks, i, n), " ")
    )
    return F.when(count >= 1, grams).otherwise(F.array().cast("array<string>"))


def clean_tokens(
    text: str | Column,
    replacement: str = "",
    stop_words: Iterable[str] | None = ENGLISH_STOP_WORDS,
    ngram: int | None = None,
) -> Column:
    """F1 -> F2 -> F3 (-> F4): the token list the feature stage consumes."""
    toks = tokenize(clean_markup(text, replacement))
    if stop_words is not None:
        # the tokens are in lower case: no second lower() a token
        toks = remove_stop_words(toks, {w.lower() for w in stop_words}, case_sensitive=True)
    if ngram:
        toks = ngrams(toks, ngram)
    return toks
