"""URL verdicts: stated host and path rules, and association rules mined from
labelled URLs.

A stated rule (``example.net/en/``) fits its host and every subdomain when the
URL's path starts with the rule's; the longest wins.  URLs that none fits are
judged by mined rules: a labelled URL becomes a set of tokens (words of the
host, the path and the query, tagged by part) and, if its document is bad, one
label item; Spark's FP-growth finds the token combinations that occur with the
label.  A rule stays when it has enough labelled rows (support), when the lower
end of its confidence's interval passes a threshold, and when no rule with
fewer of its tokens stays.  Each rule is listed in an inverted index under its
rarest token; a URL looks up its own tokens and verifies the rules it finds.

The learner is bounded by its support alone: every token that enough labelled
rows hold (at most ``1 / MIN_SUPPORT`` times a URL's mean number of them) is an
item of every transaction that has it, and every rule that passes stays.  Tokens
that occur in exactly the same labelled rows (a query's fixed parameters, say)
are one item while FP-growth runs, since any two of them add nothing to one; a
rule found with the item is then written out for each of them.  The index has one
entry a rule and goes to every task.  Every labelled row is counted; every URL is
judged by all of its tokens.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and no tokens; it fits no rule and is allowed.  Repeated labels of one id count
as one row, bad if one of them is; labels with null in both columns are not
bad.  Without labelled rows there are no mined rules.  Rows are judged
one by one, so repeated rows and ties need no rule; an empty table gives no
rows; other columns are kept by ``judged`` unless it replaces them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import fresh_name, read_table, stage_table

# fixed values: the stated rules of the query
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

MIN_ROWS = 10  # labelled rows that a rule covers
MIN_SUPPORT = 0.0005  # ... as a share of all labelled rows
MIN_CONFIDENCE = 0.5  # lower end of the confidence's interval
Z = 2.6  # its width in standard errors
BAD = "=bad"  # the label's item; tokens have a letter before the sign


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def stated_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct<rule, verdict> of the longest rule that fits (of equal lengths the
    first), else null."""
    def fits(r):
        return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)

    longest_first = sorted(rules, key=lambda r: -len(r.text))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*[F.when(fits(r), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in longest_first], none)


def url_tokens(url: Column) -> Column:
    """Distinct words of the host (h=), path (p=) and query (q=); numbers, which
    hardly repeat, are left out."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    parts = []
    for tag, part in (("h=", host_of(url)), ("p=", path_of(url)), ("q=", query)):
        words = F.filter(F.split(F.translate(part, UPPER, LOWER), BREAK), lambda w: (F.length(w) > 0) & ~w.rlike("^[0-9]+$"))
        parts.append(_tagged(words, tag))
    return F.array_distinct(F.concat(*parts))


def _tagged(words: Column, tag: str) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(tag), w))


# --- learning ----------------------------------------------------------------------


def labelled_urls(urls: DataFrame, labels: DataFrame, key: str = "page_id") -> DataFrame:
    """tokens, bad: one row per URL whose id has a label."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(F.max(bad).alias("bad"))
    own = urls.select(F.col(key).alias("url_id"), F.col("url").alias("url"))
    return own.join(known, own["url_id"] == known["label_id"]).select(url_tokens(F.col("url")).alias("tokens"), "bad")


def frequent_tokens(rows: DataFrame, least: float) -> list[str]:
    """The tokens of at least ``least`` rows: as many at most as all rows'
    tokens over ``least``."""
    seen = rows.select(F.explode_outer("tokens").alias("token")).where(F.col("token").isNotNull())
    return sorted(r["token"] for r in seen.groupBy("token").count().where(F.col("count") >= least).collect())


def twin_tokens(rows: DataFrame) -> dict[str, list[str]]:
    """The tokens of ``rows`` (``tokens``) by the first of those that occur in
    the same rows; counted over the distinct lists."""
    lists = rows.groupBy("tokens").count()
    pairs = lists.select(F.explode("tokens").alias("a"), "tokens", "count").select("a", F.explode("tokens").alias("b"), "count")
    both = pairs.groupBy("a", "b").agg(F.sum("count").alias("n"))
    alone = both.where(F.col("a") == F.col("b"))
    of = both.join(alone.select("a", F.col("n").alias("n_a")), "a").join(alone.select("b", F.col("n").alias("n_b")), "b")
    same = of.where((F.col("n") == F.col("n_a")) & (F.col("n") == F.col("n_b"))).groupBy("a").agg(F.array_sort(F.collect_list("b")).alias("twins"))
    return {r["a"]: r["twins"] for r in same.where(F.col("a") == F.col("twins")[0]).collect()}


def written_out(rules: DataFrame, twins: dict[str, list[str]]) -> DataFrame:
    """``rules`` over first twins as the rules over every choice of twins."""
    of = F.map_from_arrays(F.array(*map(F.lit, twins)), F.array(*[F.array(*map(F.lit, t)) for t in twins.values()]))
    none = F.array(F.array().cast("array<string>"))
    more = lambda found, token: F.flatten(F.transform(F.element_at(of, token), lambda t: F.transform(found, lambda f: F.array_append(f, t))))
    chosen = F.explode(F.aggregate("tokens", none, more)).alias("tokens")
    return rules.select(chosen, "hits", "rows", "confidence", "strength").withColumn("tokens", F.array_sort("tokens"))


def interval_floor(hits: Column, rows: Column, z: float = Z) -> Column:
    """Lower end of Wilson's interval of ``hits`` in ``rows``."""
    p = hits / rows
    spread = F.sqrt(p * (1 - p) / rows + z * z / (4 * rows * rows)) * z
    return (p + z * z / (2 * rows) - spread) / (1 + z * z / rows)


RULE_SCHEMA = "tokens array<string>, hits long, rows long, confidence double, strength double"


def mine_rules(
    labelled: DataFrame, min_rows: int = MIN_ROWS, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """tokens, hits, rows, confidence, strength: the combinations that mark bad
    URLs.  ``strength`` is the lower end of the confidence's interval."""
    spark = labelled.sparkSession
    labelled = stage_table(labelled, "url-labelled")
    n, n_bad = labelled.agg(F.count("*"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))).first()
    none = spark.createDataFrame([], RULE_SCHEMA)
    if not n_bad:
        return none
    least = max(min_rows, min_support * n)
    chosen = frequent_tokens(labelled, least)
    if not chosen:
        return none
    held = labelled.select(F.array_intersect(F.array(*map(F.lit, chosen)), "tokens").alias("tokens"), "bad")
    twins = twin_tokens(held)
    own = F.array_intersect(F.array(*map(F.lit, twins)), "tokens")
    items = stage_table(held.select(F.concat(own, F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array())).alias("items")), "url-items")
    # a combination with the label has at least this share of the rows
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least * min_confidence / n), minConfidence=min_confidence).fit(items)
    sets = model.freqItemsets
    with_label = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("hits")
    )
    alone = sets.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("a_tokens"), F.col("freq").alias("rows"))
    rules = with_label.join(alone, F.col("tokens") == F.col("a_tokens")).where(F.col("rows") >= least)
    rules = rules.select("tokens", "hits", "rows", (F.col("hits") / F.col("rows")).alias("confidence"), interval_floor(F.col("hits"), F.col("rows")).alias("strength"))
    kept = pruned(stage_table(rules.where(F.col("strength") >= min_confidence), "url-strong"))
    return stage_table(written_out(kept, twins), "url-written")


def pruned(rules: DataFrame) -> DataFrame:
    """Rules without those that hold all tokens of a shorter rule."""
    short = rules.select(F.col("tokens").alias("s_tokens"), F.size("tokens").alias("s_size"), F.explode("tokens").alias("token"))
    long = rules.select("tokens", F.explode("tokens").alias("token"))
    shared = short.join(long, "token").where(F.col("s_size") < F.size("tokens")).groupBy("tokens", "s_tokens", "s_size").count()
    longer = shared.where(F.col("count") == F.col("s_size")).select("tokens").distinct()
    return stage_table(rules.join(longer, "tokens", "left_anti"), "url-rules")


# --- matching ----------------------------------------------------------------------


def inverted_index(rules: DataFrame) -> Column:
    """map<token, array<struct<tokens, strength>>> with each rule under its
    rarest token, as a scalar: one entry a rule."""
    uses = rules.select(F.explode("tokens").alias("token"), "rows").groupBy("token").agg(F.max("rows").alias("most"))
    rarest = rules.select("tokens", "strength", F.explode("tokens").alias("token")).join(uses, "token").groupBy("tokens", "strength").agg(
        F.min(F.struct("most", "token"))["token"].alias("token")
    )
    lists = rarest.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("tokens", "strength"))).alias("rules"))
    return lists.agg(F.map_from_entries(F.collect_list(F.struct("token", "rules"))).alias("index")).scalar()


def fired(tokens: Column, index: Column) -> Column:
    """The strongest rule (its tokens) whose tokens all are there, else null."""
    listed = F.array_intersect(tokens, F.map_keys(index))
    found = F.flatten(F.transform(listed, lambda t: F.filter(F.element_at(index, t), lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0)))
    best = F.array_max(F.transform(found, lambda r: F.struct(r["strength"].alias("strength"), r["tokens"].alias("tokens"))))
    return F.when(F.size(found) > 0, best["tokens"])


def judged(urls: DataFrame, mined: DataFrame, rules: Sequence[Rule] = tuple(Rule(*r) for r in RULES)) -> DataFrame:
    """``urls`` with host, path, rule (the stated one that fits), mined (the
    tokens of the strongest mined rule that fits, looked up where no stated
    rule does) and verdict."""
    index, tokens, said = (fresh_name(urls, c) for c in ("url_index", "url_tokens", "url_said"))
    new = ("host", "path", "rule", "mined", "verdict")
    kept = [c for c in urls.columns if c.lower() not in new]
    read = urls.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    read = read.withColumn(said, stated_rule(F.col("host"), F.col("path"), rules))
    read = read.withColumn(tokens, F.when(F.col(said).isNull(), url_tokens(F.col("url")))).withColumn(index, inverted_index(mined))
    read = read.withColumn("mined", F.when(F.col(said).isNull(), F.array_join(fired(F.col(tokens), F.col(index)), " ")))
    verdict = F.coalesce(F.col(said)["verdict"], F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return read.select(*kept, "host", "path", F.col(said)["rule"].alias("rule"), "mined", verdict.alias("verdict"))


def op13_association_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL, judged by the stated rules and by those mined from the
    labels of the pages' ids."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    mined = mine_rules(labelled_urls(pages, read_table(spark, sf_dir, "labels")))
    return judged(pages, mined).select("page_id", "host", "path", "rule", "verdict", "mined")
