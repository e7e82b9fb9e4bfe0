"""Each stage of the pipeline against brute force, on what the stage before kept."""

from collections import Counter, defaultdict

import corpus_pipeline
from topicweave.llm import quality_rules
from topicweave.llm.common import read_table
from tests.llm.conftest import SF
from tests.llm.test_exact_dedup import brute as exact_brute
from tests.llm.test_mixing import targets
from tests.llm.test_ngram_join import brute as near_brute
from tests.llm.test_packing import expected_pieces
from tests.llm.test_quality_rules import brute as quality_brute

NAMES = ["quality rules", "exact dedup", "n-gram jaccard join", "mixing", "best-fit packing"]


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES


def test_each_stage_equals_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows_of(docs)
        source = {r.doc_id: r.source for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        out = spark.read.parquet(f"{scratch}/{k}")
        outs.append(out)
        if k < 4:
            assert out.columns == columns
        if k == 0:
            rules = quality_rules.fit_rules(docs, read_table(spark, SF, "labels"))
            judged = {r.doc_id: r for r in quality_rules.judge_documents(docs, rules).collect()}
            for doc_id, text in before:
                assert judged[doc_id].base_failed == quality_brute(text)[-1]
            assert Counter(rows_of(out)) == Counter(x for x in before if judged[x[0]].kept)
            labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
            lost = [i for i, _ in before if not judged[i].kept and not judged[i].base_failed]
            assert not [i for i in lost if labels.get(i) == 1]
        elif k == 1:
            keep = {x[1] for x in exact_brute(before)[0]}
            assert Counter(rows_of(out)) == Counter(x for x in before if x[0] in keep)
        elif k == 2:
            heads = {c for _, n, c in near_brute(before)[0] if n} | {i for i, n, _ in near_brute(before)[0] if not n}
            assert Counter(rows_of(out)) == Counter(x for x in before if x[0] in heads)
        elif k == 3:
            sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
            for i, t in before:
                n = len((t or "").split())
                sizes[source[i]] += n
                largest[source[i]] = max(largest[source[i]], n)
            copies = Counter(rows_of(out))
            assert max(copies.values()) <= 2 and set(copies) <= set(before)
            for (i, t), c in copies.items():
                taken[source[i]] += c * len((t or "").split())
            for s, want in targets(dict(sizes)).items():
                assert abs(taken[s] - want) <= largest[s] + 1
        else:
            assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == expected_pieces(before, 2048)
            assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
        docs = out
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(whole.collect()) == Counter(outs[-1].collect())
