"""Fixed values the results depend on.

Everything in this module is a FIXED VALUE: changing any entry changes the
tokens, the vocabulary and therefore every model trained on top of them.
"""

from __future__ import annotations

# --- FIXED VALUES -----------------------------------------------------------

# Markup / punctuation / digit pattern removed from descriptions before
# tokenizing (Java regex syntax; also valid RE2, so the SQL oracle reuses it).
# A match is deleted, not replaced: "foo<br>bar" -> "foobar".
MARKUP_PUNCT_DIGIT_PATTERN = r'<.*?>|[-\\/\\"_():;,.!?\\-\\*•\\|\\&\\$%]|[0-9]'

# Token separator: Java's "\s" class, written out so DuckDB's RE2 (whose "\s"
# does not include \x0B) splits on exactly the same characters.
WHITESPACE_PATTERN = "[ \t\n\x0b\f\r]+"

# Spark ML's default English stop words (StopWordsRemover), in their
# published order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are was "
    "were be been being have has had having do does did doing a an the and but "
    "if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both "
    "each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't "
    "hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't "
    "can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
).split(" ")

# Document-frequency band of the term vectorizer: a term is kept when
# MIN_DF * n_docs <= df <= MAX_DF * n_docs (both inclusive).
MIN_DF = 0.01
MAX_DF = 0.3

# Default run: topics, iterations, seed, terms per topic description.
DEFAULT_K = 6
DEFAULT_MAX_ITER = 50
DEFAULT_SEED = 100
DEFAULT_TOPIC_TERMS = 10
DEFAULT_TOP_ITEMS = 10

# Spark's CountVectorizer default vocabulary cap (2^18 terms); it is also the
# size bound that makes broadcasting the vocabulary table safe.
DEFAULT_VOCAB_SIZE = 1 << 18

# --- end of fixed values ----------------------------------------------------
