import random
import re
from collections import Counter

import numpy as np

from topicweave.llm import quality_rules as qr
from topicweave.llm.common import read_table
from tests.llm.conftest import SF


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 5))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_counts_equal_brute_force(spark, sample, tricky):
    for docs in (sample, tricky):
        want = Counter((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect())
        rows = qr.judge_documents(docs, []).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
        assert all(r.kept == (not r.base_failed) for r in rows)


def test_rules_separate_held_out_labels(spark):
    """Fit on one half of the labels, judge the other half."""
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    rules = qr.fit_rules(docs, labels.where("doc_id % 2 = 0"))
    assert rules
    rows = qr.judge_documents(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0 and not r.base_failed]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.2 * len(bad)


def test_learner_finds_planted_conjunctions():
    rnd = np.random.default_rng(0)
    n = 6000
    x = {f: rnd.random(n) for f in qr.FEATURES}
    bad = (x["symbol_share"] > 0.8) | ((x["mean_word"] <= 0.3) & (x["upper_share"] > 0.6))
    rules = qr.learn_rules(x, bad, np.arange(n) % 3 == 0)
    hit = np.zeros(n, bool)
    for r in rules:
        hit |= qr._covers(r, x, n)
    assert (hit & ~bad).sum() <= 0.02 * n
    assert (hit & bad).sum() >= 0.95 * bad.sum()


def test_noise_alone_gives_no_rule():
    rnd = np.random.default_rng(1)
    x = {f: rnd.random(2000) for f in qr.FEATURES}
    assert qr.learn_rules(x, rnd.random(2000) < 0.2, np.arange(2000) % 3 == 0) == []


def test_list_is_ordered_conditionals(spark, sample):
    rules = [(qr.Test("mean_word", True, 4.0),), (qr.Test("mean_word", True, 3.0), qr.Test("upper_share", False, 0.5))]
    rows = qr.judge_documents(sample, rules).collect()
    for r in rows:
        mean = r.word_chars / r.n_words if r.n_words else 0.0
        upper = r.n_upper / r.word_chars if r.word_chars else 0.0
        want = 0 if r.base_failed else 1 if mean > 4 else 2 if mean > 3 and upper <= 0.5 else None
        assert r.rule == want and r.kept == (want is None)


def test_labels_missing_or_of_one_kind(spark, sample, tricky, empty):
    labels = read_table(spark, SF, "labels")
    for some in (labels.where("false"), labels.where("quality = 1"), labels.selectExpr("cast(null as bigint) doc_id", "quality", "toxic")):
        assert qr.fit_rules(sample, some) == []
    assert qr.fit_rules(empty, labels) == []
    assert qr.judge_documents(empty, []).count() == 0
    rules = qr.fit_rules(tricky, labels)
    kept = qr.kept_documents(tricky, rules)
    assert kept.columns == tricky.columns
    assert kept.count() == sum(r.kept for r in qr.judge_documents(tricky, rules).collect())


def test_sample_bound(spark, sample):
    labels = read_table(spark, SF, "labels")
    assert qr.labelled_sample(sample, labels, 5).count() == 5
