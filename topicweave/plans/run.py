"""The batch topic job: offers -> items -> features -> LDA -> outputs (§3.1).

Every intermediate that is read more than once is one Parquet table in the run
folder, so the job never re-reads the raw feed, two outputs of the same run
cannot disagree, and a finished job leaves nothing outside its folder.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.functions.constants import (
    DEFAULT_K,
    DEFAULT_MAX_ITER,
    DEFAULT_SEED,
    DEFAULT_TOPIC_TERMS,
    MAX_DF,
    MIN_DF,
)
from topicweave.operators.distances import topic_distances, topic_map
from topicweave.operators.features import to_tf_idf_features, with_tokens
from topicweave.operators.lda_table import TopicInput, TopicState, first_state, fit_topics, score_documents, topic_input
from topicweave.operators.lda_table import term_shares as table_term_shares
from topicweave.operators.rollup import to_items
from topicweave.operators.stats import (
    DEFAULT_LAMBDA,
    complete_docs,
    doc_stats,
    term_relevance,
    topic_prevalence,
    vocab_stats,
)
from topicweave.operators.termtable import TermTable, fit_terms, term_entries, term_vectors
from topicweave.operators.topics import (
    LAYOUT_PARTITIONS,
    described,
    fit_lda,
    leading_terms,
    score_all,
    sweep,
    term_distribution,
    training_input,
    with_assignment,
)
from topicweave.session import ensure_checkpoint_dir
from topicweave.sources.bucketed import join_buckets, write_bucketed
from topicweave.sources.io import (
    load_features,
    load_model,
    read_offers_split,
    read_table,
    run_path,
    save_features,
    save_model,
    write_table,
)
from topicweave.sources.publish import new_attempt, publish, resolve_run
from topicweave.sources.schemas import FEATURE_COLUMNS, ROLLUP_COLUMNS


class MalformedFeed(ValueError):
    """The feed holds lines that are not offers."""


@dataclass
class JobConfig:
    """One config for the job (k=6, 50 iterations, seed 100 by default).

    ``None`` means "not given"; 0 is a valid seed.  ``vocab_size`` cuts the
    vocabulary when given; without it a vocabulary beyond the default bound is
    an error.  ``relevance_lambda`` and ``relevance_terms`` (None: all) shape
    the relevance table.  ``fail_on_rejects`` makes malformed feed lines an
    error; they are written apart in either case.  ``term_table`` keeps the
    vocabulary and the topic-term state as tables, for a vocabulary of any size
    (``max_iter`` passes over the documents, or mini-batches of
    ``topic_batches``).  ``buckets`` writes the items, their vectors, scores and
    topics in that many buckets by product name (``sources.bucketed``), so that
    ``run_side_by_side`` joins them without an exchange.
    """

    output_base: str
    source_json: str | None = None
    k: int = DEFAULT_K
    max_iter: int = DEFAULT_MAX_ITER
    seed: int = DEFAULT_SEED
    topic_terms: int = DEFAULT_TOPIC_TERMS
    version: str | None = None
    min_df: float = MIN_DF
    max_df: float = MAX_DF
    vocab_size: int | None = None
    ngram: int | None = None
    replacement: str = ""
    optimizer: str = "online"
    layout_partitions: int = LAYOUT_PARTITIONS
    exact_filter: bool = False
    relevance_lambda: float = DEFAULT_LAMBDA
    relevance_terms: int | None = None
    fail_on_rejects: bool = False
    term_table: bool = False
    topic_batches: int = 1
    buckets: int | None = None

    def with_overrides(self, **kw) -> "JobConfig":
        """Apply CLI-style overrides; a value is used when it is not None."""
        vals = {k: v for k, v in kw.items() if v is not None}
        return JobConfig(**{**self.__dict__, **vals})


def _land_offers(spark: SparkSession, config: JobConfig, out: str, paths: dict[str, str]) -> DataFrame:
    """Parse the JSON feed once: the rollup's columns as Parquet, the malformed
    lines apart with their number reported."""
    if not config.source_json:
        raise ValueError("give either an offers DataFrame or config.source_json")
    good, bad = read_offers_split(spark, config.source_json)
    paths["offers"] = write_table(good.select(*ROLLUP_COLUMNS), f"{out}/offers.parquet")
    paths["rejects"] = write_table(bad, f"{out}/rejects.parquet")
    n = read_table(spark, paths["rejects"]).count()
    if n and config.fail_on_rejects:
        raise MalformedFeed(f"{n} malformed lines, kept in {paths['rejects']}")
    if n:
        print(f"{n} malformed lines, kept in {paths['rejects']}")
    return read_table(spark, paths["offers"])


def _write_items(df: DataFrame, path: str, config: JobConfig) -> str:
    """A table of one row a product: in buckets when the config says so."""
    if config.buckets:
        return write_bucketed(df, path, "product_name", config.buckets)
    return write_table(df, path)


def run_side_by_side(spark: SparkSession, run_dir: str, left: str = "items", right: str = "item_topics") -> DataFrame:
    """Two of the tables that a run with ``buckets`` keeps by product
    (``items features scored item_topics``), joined without an exchange; columns
    of both are the left one's."""
    base = resolve_run(spark, run_dir)
    return join_buckets(spark, *(f"{base}/{ITEM_TABLES[name]}" for name in (left, right)))


ITEM_TABLES = {
    "items": "item_df.parquet", "features": "item_tf_idf_df.parquet",
    "scored": "scored.parquet", "item_topics": "item_topic_df.parquet",
}


def run_topic_job(spark: SparkSession, config: JobConfig, offers: DataFrame | None = None) -> dict[str, str]:
    """Run the whole job and return the written paths by output name.

    Everything goes into an attempt's own folder; the run's readers see it when
    the last table is there (``sources.publish``).
    """
    version = config.version or str(int(time.time()))
    run_dir = run_path(config.output_base, version, config.k, config.max_iter, config.seed)
    out = new_attempt(run_dir)
    paths: dict[str, str] = {}
    said = spark.createDataFrame([(json.dumps({**asdict(config), "version": version}),)], "config string")
    paths["config"] = write_table(said, f"{out}/config.parquet")
    if offers is None:
        offers = _land_offers(spark, config, out, paths)
    # items: written once, every later step reads the table
    paths["items"] = _write_items(to_items(offers), f"{out}/item_df.parquet", config)
    items = read_table(spark, paths["items"])

    stage = _table_topics if config.term_table else _stock_topics
    scored, terms, vocab = stage(spark, config, items, out, paths)
    stats = doc_stats(scored, exact=config.exact_filter)
    relevance = term_relevance(terms, vocab, config.relevance_lambda, config.relevance_terms)
    outputs = {
        "topics": (described(leading_terms(terms, config.topic_terms)), f"{out}/topics_df.parquet"),
        "doc_stats": (complete_docs(stats), f"{out}/lda_vis/doc_stats.parquet"),
        "doc_rejects": (complete_docs(stats, rejects=True), f"{out}/lda_vis/doc_rejects.parquet"),
        "topic_term": (terms, f"{out}/lda_vis/topic_term.parquet"),
        "prevalence": (topic_prevalence(stats), f"{out}/lda_vis/prevalence.parquet"),
        "relevance": (relevance, f"{out}/lda_vis/relevance.parquet"),
        "distances": (topic_distances(terms), f"{out}/lda_vis/distances.parquet"),
    }
    # independent outputs of one scoring pass: submitted as concurrent Spark
    # jobs so small ones do not leave the cluster idle
    with ThreadPoolExecutor(max_workers=len(outputs) + 1) as pool:
        futures = {name: pool.submit(write_table, df, path) for name, (df, path) in outputs.items()}
        futures["item_topics"] = pool.submit(_write_items, with_assignment(scored), f"{out}/item_topic_df.parquet", config)
        for name, fut in futures.items():
            paths[name] = fut.result()
    placed = topic_map(read_table(spark, paths["distances"]), read_table(spark, paths["prevalence"]))
    paths["topic_map"] = write_table(placed, f"{out}/lda_vis/topic_map.parquet")
    publish(spark, run_dir, out, paths)
    return paths


def _stock_topics(spark: SparkSession, config: JobConfig, items: DataFrame, out: str, paths: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spark ML's vectorizer and LDA: scored items, topic-term table, vocabulary."""
    paths["tokens"] = f"{out}/tokens.parquet"
    vocab_model, feats = to_tf_idf_features(
        items, config.replacement, config.ngram, config.min_df, config.max_df, config.vocab_size, paths["tokens"]
    )
    paths["features"] = _write_items(feats, f"{out}/item_tf_idf_df.parquet", config)
    features = read_table(spark, paths["features"])
    paths["feature_model"] = save_features(vocab_model, f"{out}/feature_model")
    paths["vocab"] = write_table(vocab_stats(vocab_model.vocab_df), f"{out}/lda_vis/vocab.parquet")

    training = training_input(features, "product_name", config.layout_partitions)
    model = fit_lda(training, config.k, config.max_iter, config.seed, optimizer=config.optimizer)
    paths["model"] = save_model(model, f"{out}/lda_model")
    training.unpersist()
    # the per-document inference runs once, into a table, in the feature
    # table's own partitions; the items' sets go along, so nothing is joined
    paths["scored"] = _write_items(score_all(model, features, keep=SETS), f"{out}/scored.parquet", config)
    terms = term_distribution(model, vocab_model.vocab_df, paths["model"])
    return read_table(spark, paths["scored"]), terms, vocab_model.vocab_df


SETS = ("brands", "categories")


def _table_topics(spark: SparkSession, config: JobConfig, items: DataFrame, out: str, paths: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same three tables with the vocabulary and the topic-term state as
    tables of the run: no term list and no matrix on the driver."""
    tokens = with_tokens(items, replacement=config.replacement, ngram=config.ngram).select("product_name", *SETS, "cleaned_words")
    paths["tokens"] = write_table(tokens, f"{out}/tokens.parquet")
    tokens = read_table(spark, paths["tokens"])
    fitted = fit_terms(tokens, min_df=config.min_df, max_df=config.max_df, vocab_size=config.vocab_size)
    paths["term_table"] = fitted.save(f"{out}/term_table")
    terms = TermTable.load(spark, paths["term_table"])
    paths["vocab"] = write_table(vocab_stats(terms.terms), f"{out}/lda_vis/vocab.parquet")
    vectors = term_vectors(tokens, "product_name", terms, f"{out}/term_vectors.parquet", keep=(*SETS, "cleaned_words"))
    # written once more as vectors, so that any reader of the table gets them
    paths["features"] = _write_items(vectors.select(*FEATURE_COLUMNS), f"{out}/item_tf_idf_df.parquet", config)
    data = _term_input(tokens, terms, f"{out}/topic_input")
    state = fit_topics(data, first_state(terms.terms, terms.n_terms, config.k, config.seed), config.max_iter, f"{out}/topic_states", config.topic_batches)
    paths["topic_state"] = state.save(f"{out}/topic_state")
    state = TopicState.load(spark, paths["topic_state"])
    paths["scored"] = _write_items(_scored_by_state(tokens, data, state, SETS), f"{out}/scored.parquet", config)
    data.release()
    named = table_term_shares(state).join(terms.terms.select("term_idx", "word"), "term_idx")
    return read_table(spark, paths["scored"]), named.select("topic", "term_idx", "word", "weight", "prob"), terms.terms


def _term_input(tokens: DataFrame, terms: TermTable, folder: str) -> TopicInput:
    return topic_input(term_entries(tokens, "product_name", terms), "product_name", F.col("n") * F.col("idf"), folder)


def _scored_by_state(tokens: DataFrame, data: TopicInput, state: TopicState, keep: tuple[str, ...] = ()) -> DataFrame:
    """``product_name, keep, topicDistribution array<double>, doc_length`` of
    every item; all zeros for one without terms of the vocabulary."""
    found = score_documents(data, state, "s_name")
    zeros = F.array_repeat(F.lit(0.0), state.k)
    joined = tokens.join(found, F.col("product_name").eqNullSafe(F.col("s_name")), "left")
    length = F.size(F.coalesce("cleaned_words", F.array().cast("array<string>")))
    return joined.select("product_name", *keep, F.coalesce("topicDistribution", zeros).alias("topicDistribution"), length.alias("doc_length"))


def score_items(spark: SparkSession, run_dir: str, items: DataFrame) -> DataFrame:
    """``product_name, topicDistribution, score, topic`` of raw items
    (``product_name, description``) by a finished run's saved stages."""
    base = resolve_run(spark, run_dir)
    config = json.loads(read_table(spark, f"{base}/config.parquet").first()["config"])
    if config.get("term_table"):
        tokens = with_tokens(items, replacement=config["replacement"], ngram=config["ngram"]).select("product_name", "cleaned_words")
        terms, state = TermTable.load(spark, f"{base}/term_table"), TopicState.load(spark, f"{base}/topic_state")
        data = _term_input(tokens, terms, f"{ensure_checkpoint_dir(spark)}/score-{uuid.uuid4().hex}")
        return with_assignment(_scored_by_state(tokens, data, state), ["product_name"])
    features = load_features(spark, f"{base}/feature_model")
    tokens = with_tokens(items, replacement=config["replacement"], ngram=config["ngram"])
    vectors = features.transform(tokens.select("product_name", F.col("cleaned_words").alias(features.words_col)))
    scored = load_model(f"{base}/lda_model").transform(vectors)
    return with_assignment(scored, ["product_name"])


def run_sweep(spark: SparkSession, config: JobConfig, run_dir: str, grid: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], str]:
    """M10 from the job: for each (k, iterations, seed) a model, its scored
    items and its topics, each in a folder of its own, from the features of a
    finished run; returns the folders."""
    base = resolve_run(spark, run_dir)
    features = read_table(spark, f"{base}/item_tf_idf_df.parquet")
    vocab = read_table(spark, f"{base}/feature_model/vocabulary.parquet")
    training = training_input(features, "product_name", config.layout_partitions)
    version = config.version or str(int(time.time()))
    out = {}
    for r in sweep(training, grid):
        point = run_path(config.output_base, version, r.k, r.max_iter, r.seed)
        folder = new_attempt(point)
        paths = {"model": save_model(r.model, f"{folder}/lda_model")}
        paths["item_topics"] = write_table(with_assignment(score_all(r.model, features), ["product_name"]), f"{folder}/item_topic_df.parquet")
        terms = term_distribution(r.model, vocab, paths["model"])
        paths["topics"] = write_table(described(leading_terms(terms, config.topic_terms)), f"{folder}/topics_df.parquet")
        scores = spark.createDataFrame([(r.log_likelihood, r.log_perplexity)], "log_likelihood double, log_perplexity double")
        paths["scores"] = write_table(scores, f"{folder}/scores.parquet")
        publish(spark, point, folder, paths)
        out[(r.k, r.max_iter, r.seed)] = folder
    training.unpersist()
    return out
