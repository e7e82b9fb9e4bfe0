"""Secret scans with corpus-wide ownership frequency (native).

Patterns propose candidates in every text.  Each candidate value is hashed and
counted over the corpus by distinct repositories and distinct owners (a
repository belongs to its owner).  Both counts decide how far a value has
spread: ``copied`` (an example) where many owners hold it, or several owners in
many repositories; ``shared`` where one owner uses it in several repositories;
else ``own``.  A value that is not copied and does not look like a placeholder
is live-looking.  Base kinds report every span; the method's own kinds report
live-looking ones only.

Offsets come from built-in functions: ``split`` gives the gaps between the
matches that ``regexp_extract_all`` lists, and a running sum over one
document's matches gives the places.

Defined cases: null text is empty; no spans give empty text and its SHA-256;
repeated rows give the same result each; an empty table gives no rows; other
columns are ignored; a null owner or repository counts as one value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.llm.common import HOT_ROWS, join_counted, read_table, stage_table, text_or_empty


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # Java regular expression
    group: int  # of the secret value
    min_length: int  # of that group
    base: bool = False


VALUE = r"([A-Za-z0-9+/_.=-]+)"
BIND = r"""["']?\x20*[:=]\x20*["']?"""
# --- fixed values: the base kinds, in their order ------------------------------
BASE_KINDS = (
    Kind("assign", "(?i:(password|passwd|secret|token|api_?key))" + BIND + VALUE, 2, 6, True),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20, True),
    Kind("hex", "[0-9a-f]{24,}", 0, 24, True),
)
# --------------------------------------------------------------------------------
OWN_KINDS = (
    Kind("auth", r"(?i:\b(pwd|auth|credentials?|bearer))" + r"""(?:["']?\x20*[:=]\x20*["']?|\x20)""" + r"([A-Za-z0-9+/_.=-]{16,})", 2, 16),
    Kind("blob", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}", 0, 40),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
)
MAX_OWNERS = 2
MAX_REPOSITORIES = 4  # of a value that more than one owner holds
MIN_DISTINCT_CHARS = 8
SPREAD_COUNTS = ("n_live", "n_shared", "n_copied")  # live spans, live ones of a shared value, spans of a copied one
PLACEHOLDER = r"(?i)example|sample|changeme|placeholder|your|xxxx|test|dummy|123456"


def _matches(text: Column, index: int, kind: Kind) -> Column:
    """The kind's matches as structs (kind, j, gap, width, value)."""
    zipped = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)).alias("value"),
    )
    rows = F.transform(
        zipped,
        lambda x, j: F.struct(
            F.lit(index).alias("kind"), j.alias("j"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("width"), x["value"].alias("value")
        ),
    )
    empty = F.array().cast("array<struct<kind:int,j:int,gap:int,width:int,value:string>>")
    return F.when(text.rlike(kind.pattern), rows).otherwise(empty)


def _keyed(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
        owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"),
    )


def candidate_spans(docs: DataFrame, kinds: Sequence[Kind], owner: Column, repository: Column) -> DataFrame:
    """doc_id, text_key, owner, repository, kind, start, end, value (code points)."""
    keyed = _keyed(docs, owner, repository)
    found = keyed.select(
        "doc_id", "text_key", "owner", "repository",
        F.explode(F.concat(*[_matches(F.col("text"), i, k) for i, k in enumerate(kinds)])).alias("m"),
    ).select("doc_id", "text_key", "owner", "repository", "m.*").where("width is not null")
    found = found.distinct()  # repeated rows hold the same spans
    # One document's matches of one kind, in order: a window as large as one text.
    upto = Window.partitionBy("doc_id", "text_key", "owner", "repository", "kind").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("width")).over(upto)
    long_enough = F.element_at(F.array(*[F.lit(k.min_length) for k in kinds]), F.col("kind") + 1)
    return (
        found.withColumn("end", end)
        .where(F.length("value") >= long_enough)
        .select("doc_id", "text_key", "owner", "repository", "kind", (F.col("end") - F.col("width")).alias("start"), "end", "value")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """value_hash, n_owners, n_repositories, n_spans, over the whole corpus.

    Distinct (value, owner, repository) triples collapse in the map tasks, so
    a value that a third of all rows hold costs one row per task and owner.
    """
    triples = spans.select("value_hash", "owner", "repository").groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = triples.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return per_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repositories"), F.sum("n").alias("n_spans"))


def spread(n_owners: Column, n_repositories: Column, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> Column:
    """copied, shared or own."""
    copied = (n_owners > max_owners) | ((n_owners > 1) & (n_repositories > max_repositories))
    return F.when(copied, "copied").when((n_owners == 1) & (n_repositories > 1), "shared").otherwise("own")


def live_looking(value: Column, spread_: Column) -> Column:
    """Not copied, no placeholder, varied characters with a digit."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT_CHARS
    return (spread_ != "copied") & ~value.rlike(PLACEHOLDER) & value.rlike("[0-9]") & varied


def scan_secrets(
    docs: DataFrame, owner: Column, repository: Column, kinds: Sequence[Kind] = BASE_KINDS + OWN_KINDS, max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES, hot: int = HOT_ROWS,
) -> DataFrame:
    """All reported spans: doc_id, text_key, kind, kind_name, base, start, end,
    value_hash, n_owners, n_repositories, spread, live."""
    spans = stage_table(
        candidate_spans(docs, kinds, owner, repository).withColumn("value_hash", F.unhex(F.sha2("value", 256))), "secret-spans"
    )
    counted = stage_table(ownership(spans), "secret-owners")
    names = F.array(*[F.lit(k.name) for k in kinds])
    base = F.array(*[F.lit(k.base) for k in kinds])
    told = spread(F.col("n_owners"), F.col("n_repositories"), max_owners, max_repositories)
    joined = join_counted(spans, counted, "value_hash", "n_spans", hot=hot).withColumn("spread", told)
    rows = joined.select(
        "doc_id", "text_key", "owner", "repository", "kind",
        F.element_at(names, F.col("kind") + 1).alias("kind_name"),
        F.element_at(base, F.col("kind") + 1).alias("base"),
        "start", "end", "value_hash", "n_owners", "n_repositories", "spread",
        live_looking(F.col("value"), F.col("spread")).alias("live"),
    )
    return rows.where("base or live")


def document_report(docs: DataFrame, owner: Column, repository: Column, max_owners: int = MAX_OWNERS, hot: int = HOT_ROWS) -> DataFrame:
    """One row per document with its counts and spans."""
    spans = scan_secrets(docs, owner, repository, max_owners=max_owners, hot=hot)
    place = F.struct("start", "kind", "end", "kind_name", "base")
    grouped = spans.groupBy("doc_id", "text_key", "owner", "repository").agg(
        *[F.count(F.when(F.col("kind_name") == k.name, 1)).alias(f"n_{k.name}") for k in BASE_KINDS],
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(F.col("live") & (F.col("spread") == "shared"), 1)).alias("n_shared"),
        F.count(F.when(F.col("spread") == "copied", 1)).alias("n_copied"),
        F.sort_array(F.collect_list(place)).alias("places"),
    )
    said = lambda x: F.concat_ws(":", x["kind_name"], x["start"].cast("string"), x["end"].cast("string"))
    grouped = grouped.select(
        F.col("doc_id").alias("g_id"), F.col("text_key").alias("g_key"), F.col("owner").alias("g_owner"), F.col("repository").alias("g_repo"),
        *[f"n_{k.name}" for k in BASE_KINDS], *SPREAD_COUNTS,
        F.array_join(F.transform(F.filter("places", lambda x: x["base"]), said), ",").alias("base_spans"),
        F.array_join(F.transform("places", said), ",").alias("all_spans"),
    )
    grouped = stage_table(grouped, "secret-documents")
    keyed = _keyed(docs, owner, repository).drop("text")
    same = (
        keyed["doc_id"].eqNullSafe(grouped["g_id"])
        & (keyed["text_key"] == grouped["g_key"])
        & keyed["owner"].eqNullSafe(grouped["g_owner"])
        & keyed["repository"].eqNullSafe(grouped["g_repo"])
    )
    none = F.lit("")
    return keyed.join(grouped, same, "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in BASE_KINDS],
        F.sha2(F.coalesce("base_spans", none), 256).alias("base_sha256"),
        F.coalesce("all_spans", none).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in SPREAD_COUNTS],
    )


def op4_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return document_report(docs, F.col("source"), F.struct("source", "lang"))
