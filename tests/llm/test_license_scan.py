import math
import re
from collections import Counter

from topicweave.llm import license_scan as ls

PHRASES = [("mit license".split(), "mit"), ("apache license".split(), "apache"), ("general public license".split(), "gpl")]


def brute(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(docs):
    want = Counter((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect())
    got = ls.scan_licenses(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    return got


def licensed(spark):
    bsd = dict(ls.TEMPLATES[::-1])["bsd"]
    words = bsd.split()
    texts = [
        "MIT License. mit-license MIT LICENSE", "Apache  License, the GNU General\nPublic License", "general public", "license", "MIT licenses",
        "x " * 40 + bsd.upper(), "y " * 7 + " ".join(words[:8] + ["really"] + words[8:]), " ".join(words[:6]), " ".join(words[::-1]),
        "Licensed under CC BY-NC 4.0.", "All rights reserved", "rights all reserved", "ÉMIT LICENSE mit été license", None, "", "mit license " * 300,
    ]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(5, texts[5])], "doc_id long, text string")


def test_base_equals_brute_force(spark, sample, tricky):
    check(sample)
    check(tricky)


def test_spans_of_templates(spark):
    got = {r.doc_id: r for r in check(licensed(spark))}
    assert got[5].labels == "bsd" and got[5].score == 1.0
    assert got[6].labels == "bsd" and 0.75 <= got[6].score < 1  # two diagonals, merged
    for i in (2, 3, 7, 8, 11, 13, 14):
        assert got[i].labels == "" and got[i].score == 0
    assert got[9].labels == "cc-by-nc" and got[10].labels == "reserved"
    spans = {(r.doc_id, r.label): r for r in ls.license_spans(licensed(spark)).collect()}
    assert spans[(5, "bsd")].first_word == 40 and spans[(5, "bsd")].n_span_words == len(dict(ls.TEMPLATES)["bsd"].split())
    assert spans[(6, "bsd")].first_word == 7


def test_no_python_in_the_plan(spark, sample):
    plan = ls.scan_licenses(sample)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark, empty):
    assert ls.scan_licenses(empty).count() == 0


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.labels for r in ls.scan_licenses(docs).collect()}


def test_versions_do_not_matter(spark):
    texts = {
        "Licensed under CC BY-NC 3.0": "cc-by-nc", "(c) 2019, CC BY 3.0.": "cc-by", "SPDX-License-Identifier: MIT": "mit", "CC BY-NC-SA 2.5": "cc-by-nc-sa",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl", "Mozilla Public License Version 1.1": "mpl",
        "To the extent possible under law, someone has waived all copyright and related or neighboring rights to this work.": "cc0", "CC0 1.0 Universal": "cc0",
        "// SPDX-License-Identifier: GPL-2.0-only": "gpl", "SPDX-License-Identifier: BSD-3-Clause": "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "bsd",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa", "Please cc by 5 pm": "", "SPDX license list": "", "rights of all reserved": "",
    }
    got = labels_of(spark, list(texts))
    assert {t: got[i] for i, t in enumerate(texts)} == texts


def test_one_changed_word_is_forgiven(spark):
    """In every notice of enough windows, wherever the word stands."""
    long = [(label, t.split()) for label, t in ls.ALL_TEMPLATES if ls.SHORT <= len(t.split()) - ls.K + 1 <= 20]
    texts = [(label, " ".join(w[:i] + ["changed"] + w[i + 1 :])) for label, w in long for i in range(len(w))]
    got = labels_of(spark, [t for _, t in texts])
    assert len(long) > 10
    for i, (label, t) in enumerate(texts):
        assert label in got[i].split(","), t


def test_two_changed_words_in_a_short_notice_are_not(spark):
    w = "redistributions of source code must retain the above copyright notice".split()
    assert labels_of(spark, [" ".join(w[:3] + ["x"] + w[4:7] + ["y"] + w[8:])])[0] == ""


def test_own_labels_equal_brute_force(spark, sample, tricky):
    """Windows counted in Python: spans on neighbouring diagonals."""

    def brute_labels(text):
        text = "".join(c.lower() for c in text or "")
        w = ["0" if re.match("[0-9]", x) else x for x in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)]
        at = {}
        for p in range(len(w) - 2):
            at.setdefault(tuple(w[p : p + 3]), []).append(p)
        found = set()
        for label, t in ls.ALL_TEMPLATES:
            t = t.split()
            n = len(t) - 2
            votes = sorted((p - q, q, p) for q in range(n) for p in at.get(tuple(t[q : q + 3]), []))
            clusters, last = [], None
            for d, q, p in votes:
                if last is None or d - last > ls.MERGE_GAP:
                    clusters.append([])
                clusters[-1].append((q, p))
                last = d
            need = n if n < ls.SHORT else min(math.ceil(n * ls.MIN_COVER), n - 3)
            for c in clusters:
                ps = [p for _, p in c]
                if len({q for q, _ in c}) >= need and max(ps) - min(ps) + 3 <= len(t) + 2 * ls.MERGE_GAP:
                    found.add(label)
        return found

    for docs in (sample, tricky, licensed(spark)):
        for r in ls.scan_licenses(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
            want = brute_labels(r.text) | set(filter(None, r.base_labels.split(",")))
            assert set(filter(None, r.labels.split(","))) == want, r.doc_id
