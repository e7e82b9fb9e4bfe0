"""Groups of spelling variants by a trie of letter counts.

A word's frequency vector counts its letters by ``GROUPS`` letter groups.  The
trie has one level a group, preceded by the word's length; a node's children
are the counts.  Two words that differ by one inserted, deleted or replaced
code point have vectors that differ by a surplus of one at most and a deficit
of one at most, so a search walks the trie depth first and may once follow a
count that is one more and once a count that is one less.  Words at the leaves
it reaches are compared in full.

On a cluster the trie's top (length and the first ``TOP`` groups) is the
shuffle key: each subtree is stored once, and each word is sent to the subtrees
that its search reaches from the root, with the budget that is left.  The
subtree of the smaller top asks, the other is asked, and both learn the link.
A subtree of more than ``BLOCK`` words is dealt out over several tasks, each of
which is asked, so a task holds one block whatever the number of words; asking
words stream by.  Links are never listed: a task keeps for each word their
number and the best one.

Defined cases: null texts have no runs; a null id is written as an empty
string before the colon; repeated rows count again; ties of the largest count
go to the smallest word in code-point order; an empty table, or one without
frequent words, gives no rows; other columns are ignored.  Texts are read in
slices, so a long text costs its distinct runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import is_empty, read_table, stage_table
from topicweave.llm.sqltext import crc32_sql
from topicweave.llm.textscan import chunked

LETTERS = "A-Za-zÀ-ÿ"
RUN = re.compile(f"[{LETTERS}]+")
MIN_LENGTH = 6
MIN_COUNT = 5
DOMINANCE = 5  # a form occurs at least so many times as often
SLIP = 199  # one run in so many loses a letter, by its checksum

GROUPS = 16
# The trie's levels, the telling ones of Latin scripts first: the group of a
# letter is its code point modulo GROUPS.
LEVELS = (5, 1, 9, 14, 15, 4, 2, 3, 12, 13, 0, 8, 7, 6, 10, 11)
TOP = 4  # levels below the length that make up the shuffle key
BLOCK = 20_000  # words of a subtree that one task holds
SLICE = 1 << 20  # code points scanned at a time
HELD = 200_000  # distinct words counted before they are handed on


# --- words -------------------------------------------------------------------------


def runs_of(text: str) -> Iterator[list[str]]:
    """The maximal letter runs of ``text``, some at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        while end < len(text) and RUN.match(text, end - 1, end + 1) and RUN.match(text, end, end + 1):
            end += 1  # a run is not cut
        yield RUN.findall(text, at, end)
        at = end


def slipped(prefix: int, run: str) -> str:
    """The run, or the run without one letter where its checksum says so."""
    h = zlib.crc32(run.encode(), prefix)
    if h % SLIP:
        return run
    cut = h % len(run)
    return run[:cut] + run[cut + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: words of at least ``MIN_LENGTH`` code points and ``MIN_COUNT``
    occurrences in all texts."""

    def scan(batches):
        counts: Counter = Counter()

        def told():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in chunked(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                own: Counter = Counter()  # bytes.lower() changes A-Z alone
                for runs in runs_of(text.as_py().lower().decode("utf-8", "replace")):
                    own.update(runs)
                for run, n in own.items():
                    word = slipped(prefix, run)
                    if len(word) >= MIN_LENGTH:
                        counts[word] += n
                if len(counts) > HELD:
                    yield told()
        yield told()

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scan, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# --- the trie ----------------------------------------------------------------------


def vector(word: str) -> list[int]:
    """Letter counts in the order of the trie's levels."""
    by_group = [0] * GROUPS
    for letter in word:
        by_group[ord(letter) % GROUPS] += 1
    return [by_group[g] for g in LEVELS]


def top_key(length: int, counts: list[int]) -> str:
    return ".".join(map(str, [length, *counts[:TOP]]))


def reached_tops(word: str, counts: list[int]) -> Iterator[tuple[str, int, int]]:
    """Subtrees that a search for ``word`` reaches from the root: key and the
    surplus and deficit left, for keys from the word's own one upwards."""
    own = [len(word), *counts[:TOP]]
    tops = [(counts[:TOP], 1, 1)]
    for i in range(TOP):
        more = counts[:TOP]
        more[i] += 1
        tops.append((more, 0, 1))
        for j in range(TOP):
            if j != i and counts[j]:
                both = list(more)
                both[j] -= 1
                tops.append((both, 0, 0))
        if counts[i]:
            less = counts[:TOP]
            less[i] -= 1
            tops.append((less, 1, 0))
    for top, surplus, deficit in tops:
        # the length says how much of the budget is spent in all
        for longer in (-1, 0, 1):
            spent = (1 - surplus) - (1 - deficit)
            left = longer - spent  # surplus minus deficit still to come
            if -deficit <= left <= surplus and [len(word) + longer, *top] >= own:
                yield top_key(len(word) + longer, top), surplus, deficit


def one_apart(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Leaf:
    """Words with one vector (and so one length).  Of two words one apart, one
    half of the stored word stands unchanged in the other, so a large leaf is
    looked up by halves."""

    __slots__ = ("rest", "words", "heads", "tails")
    LISTED = 12

    def __init__(self, rest: list[int]):
        self.rest, self.words, self.heads, self.tails = rest, [], None, None

    def near(self, word: str) -> list[str]:
        if len(self.words) <= self.LISTED:
            return [w for w in self.words if one_apart(w, word)]
        half = len(self.words[0]) // 2
        if self.heads is None:
            self.heads, self.tails = {}, {}
            for w in self.words:
                self.heads.setdefault(w[:half], []).append(w)
                self.tails.setdefault(w[half:], []).append(w)
        behind = len(self.words[0]) - half
        found = set(self.heads.get(word[:half], ())) | set(self.tails.get(word[-behind:], ()))
        return [w for w in found if one_apart(w, word)]


class VectorTrie:
    """Words of one subtree by the counts of the levels below its top.  A node
    is a dict from count to child, or a leaf as long as one vector is below."""

    def __init__(self):
        self.root: dict | Leaf | None = None

    def insert(self, word: str, rest: list[int]) -> None:
        if self.root is None:
            self.root = Leaf(rest)
        node, parent, step = self.root, None, None
        for depth in range(len(rest) + 1):
            if isinstance(node, Leaf):
                if node.rest == rest:
                    node.words.append(word)
                    return
                fork = {node.rest[depth]: node}  # another vector: the leaf moves one level down
                if parent is None:
                    self.root = fork
                else:
                    parent[step] = fork
                node = fork
            child = node.get(rest[depth])
            if child is None:
                leaf = node[rest[depth]] = Leaf(rest)
                leaf.words.append(word)
                return
            parent, step, node = node, rest[depth], child

    def near(self, word: str, rest: list[int], surplus: int, deficit: int) -> list[str]:
        """Stored words one apart from ``word``."""
        found: list[str] = []
        stack = [(self.root, 0, surplus, deficit)] if self.root is not None else []
        while stack:
            node, depth, more, less = stack.pop()
            if isinstance(node, Leaf):
                for mine, theirs in zip(rest[depth:], node.rest[depth:], strict=True):
                    if theirs > mine:
                        more -= theirs - mine
                    elif theirs < mine:
                        less -= mine - theirs
                if more >= 0 and less >= 0:
                    found += node.near(word)
                continue
            count = rest[depth]
            if (child := node.get(count)) is not None:
                stack.append((child, depth + 1, more, less))
            if more and (child := node.get(count + 1)) is not None:
                stack.append((child, depth + 1, more - 1, less))
            if less and (child := node.get(count - 1)) is not None:
                stack.append((child, depth + 1, more, less - 1))
        return found


# --- the distributed search ----------------------------------------------------------


class _Links:
    """For each word of a block: number of near words, and the best one."""

    def __init__(self):
        self.rows: dict[str, list] = {}

    def add(self, word: str, near: str, n: int) -> None:
        row = self.rows.get(word)
        if row is None:
            self.rows[word] = [1, n, near]
            return
        row[0] += 1
        if (-n, near) < (-row[1], row[2]):
            row[1:] = n, near

    def told(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, {}
        columns = [list(rows), *map(list, zip(*rows.values(), strict=True))] if rows else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["word", "n_near", "best_n", "best"])


def _asked(batches):
    """Every word once as stored and once for each subtree that it asks."""
    names = ["top", "asks", "word", "n", "surplus", "deficit"]
    kinds = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int8(), pa.int8()]
    for batch in chunked(batches, 2000):
        rows = []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = vector(word)
            rows.append((top_key(len(word), counts), False, word, n, 1, 1))
            rows += [(top, True, word, n, surplus, deficit) for top, surplus, deficit in reached_tops(word, counts)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _searched(batches):
    """Rows sorted by subtree and block, stored words before asking ones."""
    at, trie, counts, links = None, None, {}, _Links()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("top", "block", "asks", "word", "n", "surplus", "deficit")]
        for top, block, asks, word, n, surplus, deficit in zip(*columns, strict=True):
            if (top, block) != at:
                at, trie, counts = (top, block), VectorTrie(), {}
                yield links.told()
            full = vector(word)
            rest = full[TOP:]
            if not asks:
                trie.insert(word, rest)
                counts[word] = n
                continue
            own = top == top_key(len(word), full)
            for near in trie.near(word, rest, surplus, deficit):
                links.add(word, near, counts[near])
                if not own:  # within one subtree both words ask
                    links.add(near, word, n)
            if len(links.rows) > HELD:
                yield links.told()
    yield links.told()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n, best: of every word (word, n) that has near words
    their number and the one of largest n (ties: the smallest)."""
    sent = stage_table(words.select("word", "n").mapInArrow(_asked, "top string, asks boolean, word string, n long, surplus byte, deficit byte"), "spelling-sent")
    # subtrees beyond one block: not broadcast unless Spark finds them small
    large = sent.where(~F.col("asks")).groupBy("top").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")).where("parts > 1")
    dealt = sent.join(large.withColumnRenamed("top", "l_top"), F.col("top") == F.col("l_top"), "left")
    parts = F.coalesce("parts", F.lit(1))
    home = F.array(F.pmod(F.xxhash64("word"), parts).cast("int"))
    dealt = dealt.select(*sent.columns, F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), parts - 1)).otherwise(home)).alias("block"))
    ordered = dealt.repartition("top", "block").sortWithinPartitions("top", "block", "asks")
    found = ordered.mapInArrow(_searched, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")
    )


# --- forms and roots -------------------------------------------------------------------


def roots_of(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) -> (word, root): forms followed to the last.

    Each step of a chain multiplies n by ``DOMINANCE`` at least, so chains are
    short and without cycles; every round doubles the length followed.
    """
    ahead, step = stage_table(forms.select("word", F.col("form").alias("root")), "spelling-forms"), 0
    while True:
        beyond = ahead.select(F.col("word").alias("at"), F.col("root").alias("far"))
        joined = ahead.join(beyond, F.col("root") == F.col("at"), "left")
        ahead = stage_table(joined.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), f"spelling-roots-{step}")
        step += 1
        if is_empty(ahead.where("moved")):
            return ahead.select("word", "root")
        ahead = ahead.select("word", "root")


def spelling_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word."""
    words = stage_table(word_counts(docs), "spelling-words")
    near = near_words(words, block)
    joined = words.join(near.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left")
    formed = F.coalesce(F.col("best_n") >= DOMINANCE * F.col("n"), F.lit(False))
    table = stage_table(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")),
        "spelling-near",
    )
    roots = roots_of(table.where(F.col("form").isNotNull())).withColumnRenamed("word", "r_word")
    return table.join(roots, F.col("word") == F.col("r_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_vector_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(read_table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) GROUP BY doc_id, run),
hashed AS (SELECT run, k, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
slipped AS (
  SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k
  FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN near_n >= {DOMINANCE} * w.n THEN near END AS form, CASE WHEN near_n >= {DOMINANCE} * w.n THEN near_n END AS form_n
          FROM words w LEFT JOIN best b ON b.word = w.word),
chains AS (
  SELECT word, word AS here, 0 AS k FROM forms
  UNION ALL SELECT c.word, f.form, c.k + 1 FROM chains c JOIN forms f ON f.word = c.here WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, k) AS root FROM chains GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word
"""
