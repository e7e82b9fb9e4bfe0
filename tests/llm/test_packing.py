import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from topicweave.llm import packing as pk


def expected_pieces(rows, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or min(len(ids), capacity)
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out[(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    return out


def check(spark, docs, capacity=2048):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = pk.pack_documents(spark, docs, capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected_pieces(rows, capacity)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return got, bins


def test_sample_and_tricky(spark, sample, tricky):
    got, bins = check(spark, sample)
    total = sum(r.length for r in got)
    assert len(bins) <= 1.02 * -(-total // 2048) + 1
    check(spark, tricky)
    check(spark, tricky, 64)


def test_very_long_texts(spark):
    """Also texts that the fast splitter gives up on."""
    texts = [" " * 400_000, ("x" + " " * 70_000) * 3, "a" * 300_000, "\n" * 300_000 + "end", "<|endoftext|> 😀 é\0"]
    check(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_sequences_hold_the_pieces(spark, sample):
    packed = pk.pack_documents(spark, sample)
    whole = {r.sequence_id: r.ids for r in pk.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_plan_places_every_piece_once():
    rnd = random.Random(4)
    for _ in range(30):
        cap = rnd.choice([10, 64, 300])
        counts = np.zeros(cap + 1, np.int64)
        for _ in range(rnd.randrange(1, 200)):
            counts[rnd.randrange(1, cap + 1)] += rnd.randrange(1, 4)
        places, bins = pk.plan(counts, cap)
        fill = defaultdict(list)
        for length, a, b, m, first, offset in places.tolist():
            for rank in range(a, b):
                fill[first + (rank - a) // m].append((offset + (rank - a) % m * length, length))
        assert len(fill) == bins
        assert sum(len(x) for x in fill.values()) == counts.sum()
        for parts in fill.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= cap
        used = (counts * np.arange(cap + 1)).sum()
        assert bins <= 1.25 * -(-used // cap) + 1


def test_two_pieces_replace_the_smallest():
    counts = np.zeros(101, np.int64)
    counts[[60, 30, 22, 18]] = 1  # greedy: 60 + 30; 22 + 18 fit the gap of 40 exactly
    places, bins = pk.plan(counts, 100)
    first = sorted(r[0] for r in places.tolist() if r[4] == 0)
    assert first == [18, 22, 60] and bins == 2


def test_empty(spark, empty):
    check(spark, empty)
