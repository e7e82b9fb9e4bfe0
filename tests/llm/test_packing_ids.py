"""Ids as ``tokenizers`` gives them by default, added tokens among them."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from topicweave.llm import packing as pk
from tests.llm.conftest import SF


def plain_ids(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_token_is_one_id():
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"  {end}  \n{end}x", "<|endoftext|", f"😀{end}é\0", " " * 1_000_000 + end + " y"]
    encoder = pk.Encoder(*pk.read_vocabulary())
    want = plain_ids(texts)
    assert want[0] == [64, 220, 50256, 275]
    assert [encoder(t).tolist() for t in texts] == want
    assert encoder.slow is not None  # the last text takes the other path


def test_query_and_last_stage_hold_the_ids(spark, sample):
    rows = sample.collect()
    want = {r.doc_id: [*ids, 0] for r, ids in zip(rows, plain_ids([r.text or "" for r in rows]), strict=True)}
    for packed in (pk.op8_two_fit(spark, SF), corpus_pipeline.pack(spark, sample, SF)):
        whole = {r.sequence_id: r.ids for r in pk.sequences(packed).collect()}
        got = packed.collect()
        assert sum(r.length for r in got) == sum(len(x) // 4 for x in whole.values()) == sum(map(len, want.values()))
        for r in got:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert ids == want[r.doc_id][r.start : r.start + r.length] and zlib.crc32(r.ids) == r.ids_crc32
            assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
