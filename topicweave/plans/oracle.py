"""Independent DuckDB SQL for every SQL-expressible query in the catalog.

Written from the definitions, not from the Spark code: text cleaning with
the fixed pattern, whitespace split, stop-word filter, document-frequency
band, smoothed IDF, arg-max, top-n per group.  Floating outputs are rounded
the same way on both sides; sets are emitted as sorted, comma-joined text.
"""

from __future__ import annotations

from topicweave.functions.constants import (
    ENGLISH_STOP_WORDS,
    MARKUP_PUNCT_DIGIT_PATTERN,
    MAX_DF,
    MIN_DF,
    WHITESPACE_PATTERN,
)

ROUND = 6


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PAT = _lit(MARKUP_PUNCT_DIGIT_PATTERN)
# RE2 reads the escapes itself, so the class is written with backslash escapes
WS = "'[ \\t\\n\\x0B\\f\\r]+'"
assert WHITESPACE_PATTERN == "[ \t\n\x0b\f\r]+"
STOP = ", ".join(_lit(w) for w in ENGLISH_STOP_WORDS)


def clean_expr(col: str) -> str:
    return f"regexp_replace({col}, {PAT}, '', 'g')"


def tokens_expr(col: str) -> str:
    """F1 -> F2 -> F3 on a text column: the kept token list."""
    split = f"string_split_regex(lower({clean_expr(f"coalesce({col}, '')")}), {WS})"
    return f"list_filter({split}, lambda t: length(t) >= 1 and t not in ({STOP}))"


def _tokens_cte(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return f"tok as (select {key} as doc_id, {tokens_expr(text)} as toks from {table})"


OFFERS_CTE = """offers as (
  select p.p_name as product_name,
         cast(p.p_partkey as varchar) as item_code,
         p.p_brand as brand,
         s.s_name as retailer,
         [p.p_type, 'SIZE_' || cast(p.p_size as varchar)] as cats,
         l.l_extendedprice as e_price,
         d.text as long_description
  from lineitem l
  join part p on l.l_partkey = p.p_partkey
  join supplier s on l.l_suppkey = s.s_suppkey
  left join documents d on d.doc_id = p.p_partkey
)"""

ITEMS_CTE = f"""{OFFERS_CTE},
items as (
  select product_name,
         list_sort(list_distinct(list(item_code))) as codes,
         list_sort(list_distinct(list(brand))) as brands,
         list_sort(list_distinct(list(retailer))) as retailers,
         list_sort(list_distinct(flatten(list(cats)))) as categories,
         min(long_description) as description,
         -- micro-units summed as integers, the sum as a double, then the mean
         (cast(sum(cast(round(e_price * 1000000) as hugeint)) as double) / 1000000.0::double)
              / count(e_price) as price,
         count(item_code) as purchase_count
  from offers group by product_name
)"""


def _band_cte() -> str:
    """tok -> kept (doc, word) -> stats -> vocab(term_idx, word, doc_freq, term_frequency, idf)."""
    return f"""words as (select doc_id, unnest(toks) as w from tok),
n as (select count(*) as n from tok),
st as (select w, count(*) as tf, count(distinct doc_id) as df from words group by w),
vocab as (
  select row_number() over (order by tf desc, w asc) - 1 as term_idx, w, df, tf,
         ln((n + 1.0::double) / (df + 1.0::double)) as idf
  from st, n
  where df >= {MIN_DF}::double * n and df <= {MAX_DF}::double * n
)"""


def item_rollup() -> str:
    return f"""with {ITEMS_CTE}
select product_name,
       array_to_string(codes, ',') as codes,
       array_to_string(brands, ',') as brands,
       array_to_string(retailers, ',') as retailers,
       array_to_string(categories, ',') as categories,
       description,
       price,
       purchase_count,
       cast(len(retailers) as integer) as retrailer_count,
       cast(len(categories) as integer) as category_count,
       cast(len(brands) as integer) as brand_count,
       cast(len(codes) as integer) as code_count
from items"""


def merge_categories() -> str:
    return f"""with {ITEMS_CTE}
select product_name, array_to_string(categories, ',') as categories,
       cast(len(categories) as integer) as category_count
from items"""


def item_overview() -> str:
    return f"""with {OFFERS_CTE},
c as (select unnest(cats) as c from offers)
select (select count(distinct product_name) from offers) as product_distinct,
       (select count(distinct retailer) from offers) as retailers_distinct,
       (select count(distinct c) from c) as categories_distinct,
       (select count(distinct brand) from offers) as brands_distinct"""


def item_describe() -> str:
    cols = ["price", "code_count", "category_count", "retrailer_count", "brand_count"]
    sel = []
    for c in cols:
        sel.append(
            f"""select '{c}' as column_name, count({c}) as count,
       round(avg({c}::double), {ROUND}) as mean, round(stddev_samp({c}::double), {ROUND}) as stddev,
       round(min({c}::double), {ROUND}) as min, round(max({c}::double), {ROUND}) as max from it"""
        )
    union = "\nunion all\n".join(sel)
    return f"""with {ITEMS_CTE},
it as (select price, len(codes) as code_count, len(categories) as category_count,
              len(retailers) as retrailer_count, len(brands) as brand_count from items)
{union}"""


def clean_documents() -> str:
    return f"select doc_id, {clean_expr('text')} as cleaned from documents"


def clean_pages() -> str:
    return f"select page_id, {clean_expr('html')} as cleaned from pages"


def doc_tokens() -> str:
    return f"""with {_tokens_cte()}
select doc_id, cast(len(toks) as integer) as n_tokens, array_to_string(toks, ' ') as tokens from tok"""


def doc_bigrams() -> str:
    return f"""with {_tokens_cte()},
bg as (select doc_id, list_transform(generate_series(1, len(toks) - 1),
                                     lambda i: toks[i] || ' ' || toks[i + 1]) as g from tok)
select doc_id, cast(len(g) as integer) as n_bigrams, array_to_string(g, '|') as bigrams from bg"""


def word_count() -> str:
    return f"""with {_tokens_cte()}
select w as word, count(*) as term_frequency from (select unnest(toks) as w from tok) group by w"""


def doc_lengths() -> str:
    return f"""with {_tokens_cte()}
select doc_id, cast(len(toks) as integer) as doc_length from tok"""


def bucketed_pairing() -> str:
    return f"""with {_tokens_cte()},
{ARGMAX_CTE}
select doc_id, score, topic, cast(len(toks) as integer) as doc_length
from scored join tok on vec_id is not distinct from doc_id"""


def vocab_band() -> str:
    return f"""with {_tokens_cte()},
{_band_cte()}
select cast(term_idx as integer) as term_idx, w as word, df as doc_freq, tf as term_frequency,
       round(idf, {ROUND}) as idf
from vocab"""


def tfidf_long() -> str:
    return f"""with {_tokens_cte()},
{_band_cte()},
tf as (select doc_id, w, count(*) as c from words group by doc_id, w)
select doc_id, w as word, round(c * idf, {ROUND}) as tfidf from tf join vocab using (w)"""


def ids_to_words() -> str:
    return f"""with {_tokens_cte()},
{_band_cte()},
pos as (select doc_id, unnest(toks) as w, unnest(generate_series(1, len(toks))) as p from tok),
kept as (select doc_id, list(w order by p) as ws from pos join vocab using (w) group by doc_id)
select doc_id, cast(coalesce(len(ws), 0) as integer) as n_words,
       coalesce(array_to_string(ws, ' '), '') as words
from tok left join kept using (doc_id)"""


ARGMAX_CTE = """scored as (
  select vec_id,
         cast(list_max(embedding) as float) as score,
         cast(list_position(embedding, list_max(embedding)) - 1 as integer) as topic
  from embeddings
)"""


def argmax_assign() -> str:
    return f"with {ARGMAX_CTE}\nselect vec_id, score, topic from scored"


def topk_per_topic(n: int = 10) -> str:
    return f"""with {ARGMAX_CTE},
r as (select *, cast(row_number() over (partition by topic order by score desc, vec_id asc) as integer) as rank
      from scored)
select topic, vec_id, score, rank from r where rank <= {n}"""


def topic_categories() -> str:
    return """select lang as topic,
       array_to_string(list_sort(list_distinct(list(source))), ',') as distinct_category,
       array_to_string(list_sort(list_distinct(list(lang))), ',') as distinct_brands
from documents group by lang"""


def complete_dist_filter() -> str:
    return """with d as (
  select vec_id, list_transform(embedding, lambda x: abs(x::double)) as a from embeddings
), p as (
  select vec_id, list_transform(a, lambda x: x / list_sum(a)) as dist from d
)
select vec_id,
       cast(list_position(dist, list_max(dist)) - 1 as integer) as topic,
       cast(len(dist) as integer) as n_topics
from p where abs(list_sum(dist) - 1.0) <= 1e-9"""


def lda_vocab_stats() -> str:
    """The vocabulary the LDA model is trained on (document items)."""
    return f"""with {_tokens_cte()},
{_band_cte()}
select cast(term_idx as integer) as term_idx, w as word, tf as term_frequency from vocab"""


def lda_doc_lengths() -> str:
    return f"""with {_tokens_cte()}
select cast(doc_id as varchar) as product_name, cast(len(toks) as integer) as doc_length from tok"""


def lda_features_unpacked() -> str:
    return f"""with {_tokens_cte()},
{_band_cte()},
tf as (select doc_id, w, count(*) as c from words group by doc_id, w)
select cast(doc_id as varchar) as product_name, w as word, round(c * idf, {ROUND}) as tfidf
from tf join vocab using (w)"""


def conversation_tokens() -> str:
    return f"""with tok as (select conv_id, turn, {tokens_expr('text')} as toks from conversations)
select conv_id, turn, cast(len(toks) as integer) as n_tokens, array_to_string(toks, ' ') as tokens from tok"""


def rank_per_topic() -> str:
    return f"""with {ARGMAX_CTE}
select vec_id, topic, score,
       row_number() over (partition by topic order by score desc, vec_id asc) as rank
from scored"""


# --- topics and statistics over a stated distribution --------------------------


def _language_cte() -> str:
    return f"""{_tokens_cte()},
{_band_cte()},
lw as (select d.lang, unnest(t.toks) as w from tok t join documents d using (doc_id)),
lc as (select lang, v.term_idx, v.w, count(*) as n from lw join vocab v using (w) group by all),
lt as (select lang, sum(n) as total, row_number() over (order by lang) - 1 as topic from lc group by lang),
terms as (select cast(topic as integer) as topic, cast(term_idx as integer) as term_idx, w as word,
                 cast(n as double) / cast(total as double) as prob from lc join lt using (lang)),
top as (select *, cast(row_number() over (partition by topic order by prob desc, term_idx) - 1 as integer) as term_rank
        from terms)"""


def language_terms() -> str:
    return f"with {_language_cte()}\nselect topic, term_idx, word, round(prob, 9) as prob from terms"


def language_top_terms(n: int) -> str:
    return f"with {_language_cte()}\nselect topic, term_rank, word, round(prob, 9) as weight from top where term_rank < {n}"


def language_described(n: int) -> str:
    return f"""with {_language_cte()}
select topic, cast(count(*) as integer) as n_terms,
       string_agg(word || '=' || format('{{:.6f}}', prob), ' ' order by term_rank) as top_terms
from top where term_rank < {n} group by topic"""


def language_relevance(lam: float) -> str:
    return f"""with {_language_cte()},
pw as (select cast(term_idx as integer) as term_idx, tf / sum(tf) over () as p_w from vocab)
select topic, term_idx, word, round(prob, 6) as prob, round(p_w, 6) as p_w, round(prob / p_w, 6) as lift,
       round({lam}::double * ln(prob) + (1.0 - {lam}::double) * ln(prob / p_w), 6) as relevance
from terms join pw using (term_idx)"""


def _embedding_cte() -> str:
    return f"""{_tokens_cte()},
a as (select vec_id, list_transform(embedding, lambda x: abs(x::double)) as a from embeddings),
p as (select vec_id, case when vec_id % 3 = 0 then a else list_transform(a, lambda x: x / list_sum(a)) end as dist from a),
st as (select vec_id, cast(len(toks) as integer) as doc_length, dist, list_sum(dist) as s
       from p join tok on doc_id = vec_id)"""


def embedding_doc_stats() -> str:
    return f"""with {_embedding_cte()}
select vec_id, doc_length, cast(len(dist) as integer) as n_topics, round(s, 6) as dist_sum,
       abs(s - 1.0) <= 1e-9 as complete from st"""


def embedding_complete() -> str:
    return f"""with {_embedding_cte()}
select vec_id, doc_length, cast(list_position(dist, list_max(dist)) - 1 as integer) as topic
from st where abs(s - 1.0) <= 1e-9"""


def embedding_incomplete() -> str:
    return f"with {_embedding_cte()}\nselect vec_id, doc_length from st where not abs(s - 1.0) <= 1e-9"


def embedding_prevalence() -> str:
    return f"""with {_embedding_cte()},
ex as (select doc_length, unnest(dist) as p, unnest(generate_series(1, len(dist))) - 1 as topic
       from st where abs(s - 1.0) <= 1e-9),
m as (select cast(topic as integer) as topic, sum(doc_length * p) as token_mass from ex group by topic)
select topic, round(token_mass, 3) as token_mass,
       round(token_mass / sum(token_mass) over (), 9) as prevalence from m"""


def merged_sets() -> str:
    return """with m as (select p_partkey, list_sort(list_distinct([p_type, p_brand, p_name])) as m from part)
select p_partkey, cast(len(m) as integer) as n, array_to_string(m, '|') as members from m"""


def top_items(n: int) -> str:
    return f"""with {ARGMAX_CTE},
named as (select s.topic, s.score, cast(s.vec_id as varchar) as product_name, d.lang as categories, d.source as brands
          from scored s join documents d on d.doc_id = s.vec_id),
r as (select *, row_number() over (partition by topic order by score desc, product_name asc) as rank from named)
select topic, product_name, categories, brands from r where rank <= {n}"""


def item_describe_typed() -> str:
    cols = ["price", "code_count", "category_count", "retrailer_count", "brand_count"]
    stats = {"count": "count({c})", "mean": "avg({c}::double)", "stddev": "stddev_samp({c}::double)", "min": "min({c})", "max": "max({c})"}
    rows = [
        f"select '{name}' as summary, " + ", ".join(f"round(cast({f.format(c=c)} as double), {ROUND}) as {c}" for c in cols) + " from it"
        for name, f in stats.items()
    ]
    union = "\nunion all\n".join(rows)
    return f"""with {ITEMS_CTE},
it as (select price, len(codes) as code_count, len(categories) as category_count,
              len(retailers) as retrailer_count, len(brands) as brand_count from items)
{union}"""


# --- state that grows; vocabulary and topics as tables --------------------------


def item_rollup_withdrawn() -> str:
    return f"""with {OFFERS_CTE}
select product_name, array_to_string(list_sort(list_distinct(list(retailer))), ',') as retailers,
       round((cast(sum(cast(round(e_price * 1000000) as hugeint)) as double) / 1000000.0::double) / count(e_price), {ROUND}) as price,
       count(item_code) as purchase_count
from offers where not regexp_matches(retailer, '[0369]$') group by product_name"""


def overview_runs() -> str:
    kinds = {"product": "product_name", "retailers": "retailer", "brands": "brand", "categories": "unnest(cats)"}
    parts = {"first": "where cast(floor(e_price) as bigint) % 2 = 0", "second": "where cast(floor(e_price) as bigint) % 2 <> 0", "union": ""}
    rows = [
        f"select '{run}' as run, '{kind}' as kind, count(distinct v) as n_distinct from (select {expr} as v from offers {where})"
        for run, where in parts.items()
        for kind, expr in kinds.items()
    ]
    return f"with {OFFERS_CTE}\n" + "\nunion all\n".join(rows)


def band_words() -> str:
    return f"with {_tokens_cte()},\n{_band_cte()}\nselect w as word, df as doc_freq, tf as term_frequency from vocab"


def word_ids() -> str:
    return f"""with {_tokens_cte()},
{_band_cte()},
pos as (select doc_id, unnest(toks) as w, unnest(generate_series(1, len(toks))) as p from tok),
kept as (select doc_id, list(term_idx order by p) as ids from pos join vocab using (w) group by doc_id)
select doc_id, cast(coalesce(len(ids), 0) as integer) as n_ids,
       coalesce(array_to_string(list_transform(ids, lambda i: i::varchar), ' '), '') as ids
from tok left join kept using (doc_id)"""


def language_distances() -> str:
    """Every pair over every term, absent shares as zero."""
    return f"""with {_language_cte()},
ids as (select distinct topic from terms),
pairs as (select a.topic as topic_a, b.topic as topic_b from ids a join ids b on a.topic < b.topic),
shared as (
  select p.topic_a, p.topic_b, v.term_idx, coalesce(x.prob, 0) as p, coalesce(y.prob, 0) as q
  from pairs p, vocab v
  left join terms x on x.topic = p.topic_a and x.term_idx = v.term_idx
  left join terms y on y.topic = p.topic_b and y.term_idx = v.term_idx)
select topic_a, topic_b,
       round(sum(case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end) / 2, 9) as distance
from shared group by topic_a, topic_b"""


def language_term_shares() -> str:
    return f"""with {_language_cte()},
ids as (select distinct topic from terms)
select i.topic, cast(v.term_idx as integer) as term_idx, v.w as word,
       round(coalesce(t.prob, 0), 9) as weight, round(coalesce(t.prob, 0) / sum(coalesce(t.prob, 0)) over (partition by i.topic), 9) as prob
from ids i cross join vocab v left join terms t on t.topic = i.topic and t.term_idx = v.term_idx"""
