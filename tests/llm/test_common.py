import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from topicweave.llm import common, components, textscan


def test_scope_removes_what_was_staged(spark):
    with common.scratch_scope(spark):
        table = common.stage_table(spark.range(10), "scope")
        folder = os.path.dirname(table.inputFiles()[0].replace("file://", ""))
        assert table.count() == 10 and os.path.exists(folder)
    assert not os.path.exists(folder)
    outside = common.stage_table(spark.range(3), "no-scope")
    assert outside.count() == 3


def test_staged_empty_table_keeps_its_schema(spark, empty):
    out = common.stage_table(empty, "empty")
    assert out.count() == 0 and out.columns == empty.columns


def test_batch_setting_is_put_back(spark):
    before = spark.conf.get(common.ARROW_ROWS)
    with pytest.raises(ValueError), common.small_batches(spark):
        assert spark.conf.get(common.ARROW_ROWS) == str(common.TEXTS_PER_BATCH)
        raise ValueError
    assert spark.conf.get(common.ARROW_ROWS) == before


def test_words_and_hashes_of_a_batch(monkeypatch):
    monkeypatch.setattr(textscan, "SEGMENT", 50)
    rnd = random.Random(2)
    alphabet = ["a", "b", "é", "漢", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\xa0", " ", "\x85"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(200)] + [None, "", "x" * 400, " x" * 90]
    buf, offs = textscan.buffer_of(pa.array(texts))
    starts, ends, bounds = textscan.words(buf, offs)
    hashes = textscan.word_hashes(buf, starts, ends)
    seen = {}
    for i, t in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        got = [bytes(buf[a:b]).decode() for a, b in zip(starts[bounds[i] : bounds[i + 1]], ends[bounds[i] : bounds[i + 1]])]
        assert got == want
        for w, h in zip(got, hashes[bounds[i] : bounds[i + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_every_row_once():
    texts = pa.array(["a" * n for n in (5, 0, 100, 3, 3, 3, 0, 50)])
    for size in (1, 6, 60, 1000):
        got = list(textscan.slices(texts, size))
        assert [i for a, b in got for i in range(a, b)] == list(range(8))


def test_components_equal_union_find(spark):
    rnd = random.Random(7)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 480)] + [(1000, 1000 + i) for i in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    rnd.shuffle(links)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_powers_are_inverse():
    n = 100
    assert np.array_equal(textscan.powers(n) * textscan.powers(n, textscan.BASE_INVERSE), np.ones(n, np.uint64))
