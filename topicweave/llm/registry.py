"""The thirteen operators' queries and their SQL."""

from __future__ import annotations

from topicweave.llm.exact_dedup import OP5_SQL, op5_stream_dedup
from topicweave.llm.license_scan import op10_diagonal_licenses
from topicweave.llm.merkle import OP12_SQL, op12_checkpoint_manifest
from topicweave.llm.mixing import op2_pivotal_mix
from topicweave.llm.ngram_join import op7_grouped_prefix
from topicweave.llm.packing import op8_two_fit
from topicweave.llm.quality_rules import op1_rule_list
from topicweave.llm.secret_scan import op4_ownership_secrets
from topicweave.llm.sharding import op6_table_shards
from topicweave.llm.spelling import OP11_SQL, op11_vector_trie
from topicweave.llm.suffix_dedup import op3_deep_shallow
from topicweave.llm.url_filter import op13_association_urls
from topicweave.llm.warc import OP9_SQL, op9_warc_chain

QUERIES = {
    "op1_rule_list": op1_rule_list,
    "op2_pivotal_mix": op2_pivotal_mix,
    "op3_deep_shallow": op3_deep_shallow,
    "op4_ownership_secrets": op4_ownership_secrets,
    "op5_stream_dedup": op5_stream_dedup,
    "op6_table_shards": op6_table_shards,
    "op7_grouped_prefix": op7_grouped_prefix,
    "op8_two_fit": op8_two_fit,
    "op9_warc_chain": op9_warc_chain,
    "op10_diagonal_licenses": op10_diagonal_licenses,
    "op11_vector_trie": op11_vector_trie,
    "op12_checkpoint_manifest": op12_checkpoint_manifest,
    "op13_association_urls": op13_association_urls,
}

ORACLE = {"op5_stream_dedup": OP5_SQL, "op9_warc_chain": OP9_SQL, "op11_vector_trie": OP11_SQL, "op12_checkpoint_manifest": OP12_SQL}
