"""Quality rules: an ordered decision list learned by sequential covering.

Labelled documents give per-document statistics; rules that cover bad ones are
grown one threshold test at a time (by information gain), pruned on held-out
rows, and added until no rule is precise enough.  The list becomes one ordered
Spark conditional expression.

Statistics are computed in the map tasks, whole text by whole text.  The
learner reads a bounded sample of labelled rows (``SAMPLE_ROWS``, those with
the smallest id hash); everything else covers all rows.

Defined cases: null text is empty; a document without words fails the base
rules; without labels (or with labels of one kind) only the base rules act; a
document that is labelled both ways counts as good; an empty table gives no
rows; other columns are kept by ``kept_documents`` and dropped by the query.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import fresh_name, read_table
from topicweave.llm.textscan import buffer_of, chunked, slices, windows, word_hashes, words

SAMPLE_ROWS = 20_000
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_bare")
#: What the rules test: the counts that matter, as shares.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "bare_share": ("n_bare", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "mean_word": ("word_chars", "n_words"),
}
FEATURES = tuple(RATIOS)


def _class_of(chars: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[ord(c) for c in chars]] = 1
    return table


SYMBOLS = _class_of("#*$%&|<>")
UPPER = _class_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = _class_of("0123456789")
MARKS = _class_of("!?;:,.=+~^_/\\@\"'()[]{}-")
CODE_POINT = np.ones(256, np.int64)
CODE_POINT[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
CODE_POINT[0x80:0xC0] = 0  # bytes that continue a character
PLAIN = np.zeros(256, np.int64)  # letters, digits and non-ASCII bytes
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _sums(table: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    run = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(table[buf], out=run[1:])
    return run[offs[1:]] - run[offs[:-1]]


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """Words inside k-word windows that a text holds twice or more."""
    n_docs = len(bounds) - 1
    shingle, first, doc = windows(hashes, bounds, k)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(shingle):
        order = np.lexsort((shingle, doc))
        s, d = shingle[order], doc[order]
        same = (s[1:] == s[:-1]) & (d[1:] == d[:-1])
        twice = np.zeros(len(s), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = first[order[twice]]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + k, -1)
    run = np.zeros(len(hashes) + 1, np.int64)
    np.cumsum(np.cumsum(covered[:-1]) > 0, out=run[1:])
    return (run[bounds[1:]] - run[bounds[:-1]]) if n_docs else np.zeros(0, np.int64)


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of one batch."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    parts: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS}
    for a, b in slices(texts):
        part = texts.slice(a, b - a)
        buf, offs = buffer_of(part)
        starts, ends, bounds = words(buf, offs)
        plain = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(PLAIN[buf], out=plain[1:])
        bare_run = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(plain[ends] == plain[starts], out=bare_run[1:])
        lines, dup = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
        data = buf.tobytes()
        for i in range(b - a):
            full = [x for x in data[offs[i] : offs[i + 1]].split(b"\n") if x.strip()]
            lines[i], dup[i] = len(full), len(full) - len(set(full))
        got = {
            "n_words": np.diff(bounds),
            "word_chars": _sums(CODE_POINT, buf, offs),
            "n_symbols": _sums(SYMBOLS, buf, offs),
            "n_dup_lines": dup,
            "n_repeat_words": _repeat_words(word_hashes(buf, starts, ends), bounds, REPEAT_WINDOW),
            "n_lines": lines,
            "n_upper": _sums(UPPER, buf, offs),
            "n_digits": _sums(DIGITS, buf, offs),
            "n_marks": _sums(MARKS, buf, offs),
            "n_bare": bare_run[bounds[1:]] - bare_run[bounds[:-1]],
        }
        for c in COUNTS:
            parts[c].append(got[c])
    return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in parts.items()}


def with_counts(df: DataFrame, text: str, stats: str, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` of ``df`` and the struct ``stats`` with the counts of ``text``."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep) + f", `{stats}` struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(stats))
    n = len(keep)

    def scan(batches):
        for batch in chunked(batches):
            counts = text_counts(batch.column(n))
            struct = pa.StructArray.from_arrays([pa.array(counts[c], pa.int64()) for c in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], struct], [*keep, stats])

    return source.mapInArrow(scan, schema)


def base_failed(stats: str) -> Column:
    n, r = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


def ratio(stats: str, name: str) -> Column:
    over, under = RATIOS[name]
    d = F.col(f"{stats}.{under}")
    return F.when(d > 0, F.col(f"{stats}.{over}") / d).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def on(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self, stats: str) -> Column:
        c = ratio(stats, self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for t in rule:
        hit &= t.on(x)
    return hit


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, Test | None]:
    """The threshold test of greatest information gain for the bad rows."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    if not p0 or not n0:
        return 0.0, None
    base, best, chosen = math.log2(p0 / (p0 + n0)), 1e-9, None
    for name in FEATURES:
        order = np.argsort(x[name], kind="stable")
        v, b = x[name][order], bad[order]
        p = np.cumsum(b)
        n = np.cumsum(~b)
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        for above in (False, True):
            pc, nc = (p0 - p[cut], n0 - n[cut]) if above else (p[cut], n[cut])
            gain = np.where(pc > 0, pc * (np.log2(np.maximum(pc, 1) / np.maximum(pc + nc, 1)) - base), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, chosen = float(gain[k]), Test(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best, chosen


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray, min_precision: float = 0.97, min_cover: int = 8, max_tests: int = 4) -> list[Rule]:
    """Sequential covering.  ``held`` marks the rows that prune and accept rules."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while True:
        grow, prune = left & ~held, left & held
        xs = {k: v[grow] for k, v in x.items()}
        b, rule = bad[grow], ()
        inside = np.ones(len(b), bool)
        while len(rule) < max_tests and (~b[inside]).any() and b[inside].any():
            _, test = _best_test({k: v[inside] for k, v in xs.items()}, b[inside])
            if test is None:
                break
            rule += (test,)
            inside &= test.on(xs)
        if not rule:
            break
        xp, bp = {k: v[prune] for k, v in x.items()}, bad[prune]
        kept, best = rule, -2.0
        for size in range(len(rule), 0, -1):  # drop final tests while that does not hurt
            hit = _covers(rule[:size], xp, len(bp))
            p, n = int(bp[hit].sum()), int((~bp[hit]).sum())
            score = (p - n) / (p + n) if p + n else -1.0
            if score >= best:
                kept, best = rule[:size], score
        hit_held = _covers(kept, xp, len(bp))
        hit = _covers(kept, x, len(bad)) & left
        p_held, n_held = int(bp[hit_held].sum()), int((~bp[hit_held]).sum())
        p_all, n_all = int(bad[hit].sum()), int((~bad[hit]).sum())
        precise = p_all >= min_cover and p_all >= min_precision * (p_all + n_all) and p_held >= min_precision * (p_held + n_held)
        if not precise:
            break
        rules.append(kept)
        left &= ~hit
        if not (bad & left).any():
            break
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and label of at most ``rows`` labelled documents: the ids with
    the smallest hashes, so the choice does not depend on the layout."""
    by_id = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("l_id")
    ).agg(F.max("quality").alias("quality"))
    chosen = by_id.orderBy(F.xxhash64("l_id"), "l_id").limit(rows)
    # At most `rows` rows of two numbers: a bound that is a parameter.
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    return with_counts(picked, "text", "stats", ["l_id", "quality"])


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list; rows that fail the base rules are left out."""
    sample = labelled_sample(docs, labels, rows).where(~base_failed("stats"))
    got = sample.select("quality", F.pmod(F.xxhash64("l_id", F.lit(7)), F.lit(3)).alias("fold"), "l_id", *[ratio("stats", f).alias(f) for f in FEATURES])
    # Repeated ids would exceed the sample's bound; the same limit holds here.
    got = got.orderBy("l_id", *FEATURES).limit(rows).toPandas()
    if not len(got):
        return []
    x = {f: got[f].to_numpy(float) for f in FEATURES}
    return learn_rules(x, got["quality"].to_numpy() == 0, got["fold"].to_numpy() == 0)


def verdict(rules: Sequence[Rule], stats: str) -> tuple[Column, Column]:
    """(kept, number of the deciding rule: 0 base, 1.. the list's, null none)
    as ordered conditional expressions."""
    kept, which = F.when(base_failed(stats), F.lit(False)), F.when(base_failed(stats), F.lit(0))
    for k, rule in enumerate(rules, 1):
        hit = rule[0].column(stats)
        for t in rule[1:]:
            hit = hit & t.column(stats)
        kept, which = kept.when(hit, F.lit(False)), which.when(hit, F.lit(k))
    return kept.otherwise(F.lit(True)), which.otherwise(F.lit(None).cast("int"))


def judge_documents(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """doc_id, the counts, base_failed, kept, rule."""
    rows = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", "stats", ["doc_id"])
    kept, which = verdict(rules, "stats")
    return rows.select("doc_id", "stats.*", base_failed("stats").alias("base_failed"), kept.alias("kept"), which.alias("rule"))


def kept_documents(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    stats = fresh_name(docs, "text_stats")
    kept, _ = verdict(rules, stats)
    return with_counts(docs, "text", stats, docs.columns).where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_rule_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = fit_rules(docs, read_table(spark, sf_dir, "labels"))
    return judge_documents(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
