"""A Merkle manifest of a data set, stored every few levels.

Each document is a leaf; the leaves of one source form a tree, and the sources'
roots form one more.  Of all levels only every ``every``-th one is kept, as
aligned blocks of fan-out ** every digests.  A block is a bounded group, and
all nodes between two kept levels follow from one block alone: proof
extraction joins a block with the path of its own root, computes the levels in
between again, hands each member its siblings, and forgets them.

Positions come from a range sort: a source of any size is spread over many
partitions, and each partition needs one carried offset, that of the source
that began before it.

Defined cases: a null field is written ``-``, an empty text ``0:``; null
sources form a tree of their own, before all others; null ids come first in
their source; rows with equal ids are ordered by digest, and equal rows are
leaves of their own; an empty table has no rows and no root; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicweave.llm.common import is_empty, read_table, stage_table
from topicweave.llm.sqltext import crc32_sql

FANOUT = 16
EVERY = 2  # one level of two is stored: blocks of 256 digests
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A field as hashed: its length in bytes and its text, or ``-``."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[framed(f) for f in fields])


# --- positions -----------------------------------------------------------------


def numbered(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` (with a column ``tree``) and ``pos``, each one's place in its
    tree by ``order``, from 0.  Nulls come first.

    What is broadcast has one row a partition at most.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    kinds = T.StructType([*nodes.schema.fields, T.StructField("part", T.LongType()), T.StructField("at", T.LongType())])

    def count(batches):
        part, tree, at = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for value in batch.column(batch.schema.get_field_index("tree")).to_pylist():
                if value != tree:
                    tree, at = value, 0
                places.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(places), pa.int64()), pa.array(places, pa.int64())], [*batch.schema.names, "part", "at"]
            )

    ordered = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage_table(ordered.mapInArrow(count, kinds), name)
    parts = placed.groupBy("part", "tree").agg((F.max("at") + 1).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a partition is sorted by tree, so one tree alone can have begun before it
    begun = parts.select(F.col("part").alias("b_part"), F.col("tree").alias("b_tree"), F.sum("n").over(earlier).alias("before")).where("before > 0")
    joined = placed.join(F.broadcast(begun), (F.col("part") == F.col("b_part")) & F.col("tree").eqNullSafe(F.col("b_tree")), "left")
    return joined.withColumn("pos", F.col("at") + F.coalesce("before", F.lit(0))).drop("part", "at", "b_part", "b_tree", "before")


# --- trees -----------------------------------------------------------------------


def raised(digests: Column) -> Column:
    """The level above: one digest of each run of ``FANOUT``."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * FANOUT + 1, FANOUT), "").cast("binary"), 256))


def blocks(nodes: DataFrame, every: int, *carried: str) -> DataFrame:
    """tree, block, members (by position, at most FANOUT ** every)."""
    size = FANOUT**every
    member = F.struct("pos", "digest", *carried)
    return nodes.groupBy("tree", F.expr(f"pos div {size}").alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))


def with_levels(block_rows: DataFrame, every: int) -> DataFrame:
    """The levels l0 .. l<every> that a block's digests give, and ``up``: how
    many of them lie below the tree's root or the next stored level.

    A tree that has more than one block passes all levels in each of them; in
    a lone block that is not full the tree may end earlier.
    """
    out = block_rows.withColumn("l0", F.transform("members", lambda m: m["digest"]))
    for j in range(1, every + 1):
        out = out.withColumn(f"l{j}", raised(F.col(f"l{j - 1}")))
    lone = (F.col("block") == 0) & (F.size("l0") < FANOUT**every)
    up = F.lit(every)
    for j in reversed(range(every)):
        up = F.when(lone & (F.size(f"l{j}") == 1), F.lit(j)).otherwise(up)
    return out.withColumn("up", up)


def block_roots(levels: DataFrame, every: int) -> DataFrame:
    """tree, pos, digest: one node a block, the next stored level."""
    root = F.coalesce(*[F.when(F.col("up") == j, F.col(f"l{j}")[0]) for j in range(every + 1)])
    return levels.select("tree", F.col("block").alias("pos"), root.alias("digest"))


@dataclass
class Forest:
    """The stored levels of all trees, lowest first, and their roots."""

    stored: list[DataFrame]  # tree, block, members
    roots: DataFrame  # tree, digest
    every: int


def grow(nodes: DataFrame, name: str, every: int = EVERY, carried: Sequence[str] = ()) -> Forest:
    """The trees over ``nodes`` (tree, pos, digest and ``carried``)."""
    stored = []
    while True:
        level = stage_table(blocks(nodes, every, *(carried if not stored else ())), f"{name}-{len(stored)}")
        stored.append(level)
        nodes = block_roots(with_levels(level, every), every)
        if is_empty(level.where("block > 0")):
            return Forest(stored, nodes.select("tree", "digest"), every)


def _path(every: int, i: Column) -> Column:
    """Member ``i``'s siblings on each level inside its block, left and right
    of its own place."""
    steps = []
    for j in range(every):
        level, at = F.col(f"l{j}"), F.floor(i / FANOUT**j).cast("int")
        first = (at - at % FANOUT) + 1
        left = F.array_join(F.slice(level, first, at % FANOUT), "")
        right = F.array_join(F.slice(level, at + 2, FANOUT - 1 - at % FANOUT), "")
        steps.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*steps), 1, F.col("up"))


def _reported(every: int, columns) -> Column:
    """``columns(member, its whole path)`` of every member of a block."""
    return F.transform("members", lambda m, i: F.struct(*columns(m, F.concat(_path(every, i), F.col("path")))))


def extract(forest: Forest, paths: DataFrame, emit) -> DataFrame:
    """One row per leaf, from the whole paths of the roots (tree, path).

    ``emit(member, path)`` gives the columns that a leaf is reported with.
    Interior levels of a block live in the row that recomputes them.
    """
    above = paths.select(F.col("tree").alias("a_tree"), F.lit(0).cast("long").alias("a_pos"), "path")
    for k in reversed(range(len(forest.stored))):
        level = with_levels(forest.stored[k], forest.every)
        # a path compresses well on disk, so Spark would take it for a small table
        joined = level.join(above.hint("merge"), level["tree"].eqNullSafe(above["a_tree"]) & (level["block"] == above["a_pos"]))

        columns = (lambda m, path: [m["pos"].alias("a_pos"), path.alias("path")]) if k else emit
        found = joined.select("tree", F.explode(_reported(forest.every, columns)).alias("x"))
        if k:
            above = stage_table(found.select(F.col("tree").alias("a_tree"), "x.*"), "merkle-paths")
        else:
            return found.select("tree", "x.*")
    raise ValueError("a forest has one stored level at least")


def fold(claim: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings lead to."""
    return F.aggregate(path, claim, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


# --- manifest of documents -------------------------------------------------------


@dataclass
class Manifest:
    documents: Forest  # trees by source; leaves carry doc_id and the claim
    sources: Forest | None  # the tree of the sources' roots (None: no document)
    named: DataFrame | None  # tree, pos, digest, source of that tree's leaves
    root: str | None


def leaf_table(docs: DataFrame, claim_text: Column | None = None) -> DataFrame:
    """source, doc_id, leaf and claim: the digest of the same row with
    ``claim_text`` as its text (the leaf itself where that is null or not given)."""
    own = docs.select(*FIELDS, (claim_text if claim_text is not None else F.lit(None).cast("string")).alias("claim_text"))
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    claim = F.when(F.col("claim_text").isNotNull(), leaf_digest([*[F.col(c) for c in FIELDS[:-1]], F.col("claim_text")]))
    return own.select(F.col("source").alias("tree"), "doc_id", leaf.alias("digest"), claim.alias("claim"), F.monotonically_increasing_id().alias("row"))


def build_manifest(docs: DataFrame, claim_text: Column | None = None, every: int = EVERY) -> Manifest:
    """Leaves, the sources' trees and the tree of their roots."""
    # one scan of the texts; the sort below samples the table of digests
    leaves = stage_table(leaf_table(docs, claim_text), "merkle-leaves")
    placed = numbered(leaves, ["doc_id", "digest", "row"], "merkle-places")
    trees = grow(placed, "merkle-source", every, ("doc_id", "claim"))
    if is_empty(leaves):
        return Manifest(trees, None, None, None)
    roots = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    named = numbered(roots, ["source"], "merkle-roots")
    top = grow(named, "merkle-top", every, ("source",))
    return Manifest(trees, top, named, top.roots.first()["digest"])


def proofs(manifest: Manifest, emit) -> DataFrame:
    """One row per document: ``emit(member, subroot, path)``, the path leading
    from the leaf through its source's root to the root."""
    spark = manifest.documents.roots.sparkSession
    start = spark.createDataFrame([("", [])], "tree string, path array<struct<left:string,right:string>>")
    tops = extract(manifest.sources, start, lambda m, path: [m["source"].alias("source"), m["digest"].alias("subroot"), path.alias("path")])
    tops = stage_table(tops.drop("tree"), "merkle-top-paths")
    # the source's root goes along as a last step that proofs leave out
    paths = tops.select(F.col("source").alias("tree"), F.concat("path", F.array(F.struct(F.col("subroot").alias("left"), F.lit("").alias("right")))).alias("path"))

    def split(m, path):
        return emit(m, F.element_at(path, -1)["left"], F.slice(path, 1, F.size(path) - 1))

    return extract(manifest.documents, paths, split)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_checkpoint_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, each row's proof, and what rows that were
    lower-cased on the way prove."""
    docs = read_table(spark, sf_dir, "documents")
    return proven_documents(docs)


def proven_documents(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = build_manifest(docs, F.when(tampered, F.translate("text", UPPER, LOWER)), every)
    if manifest.root is None:
        kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], kinds)

    def emit(m, subroot, path):
        claim = F.coalesce(m["claim"], m["digest"])
        return [
            m["doc_id"].cast("long").alias("doc_id"), m["digest"].alias("leaf"), subroot.alias("subroot"),
            proof_digest(path).alias("proof_sha256"), fold(claim, path).alias("folded_root"),
        ]

    rows, root = proofs(manifest, emit), F.lit(manifest.root)
    return rows.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))



def _framed_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_framed_sql(c) for c in (*FIELDS[:-1], text)) + ")"


def _steps_sql(name: str, leaves: str, nodes: str, tree: str) -> str:
    """Siblings of every leaf on every level below its tree's root."""
    inside = f"n.{tree} IS NOT DISTINCT FROM l.{tree} AND n.pos // 16 = (l.pos >> (4 * n.lvl)) // 16"
    return f"""{name} AS (
  SELECT l.{tree}, l.pos, n.lvl,
         coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos < l.pos >> (4 * n.lvl)), '') AS lft,
         coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos > l.pos >> (4 * n.lvl)), '') AS rgt
  FROM {leaves} l JOIN {nodes} n ON {inside}
  JOIN (SELECT {tree}, max(lvl) AS top FROM {nodes} GROUP BY ALL) h ON h.{tree} IS NOT DISTINCT FROM l.{tree} AND n.lvl < h.top
  GROUP BY ALL)"""


def _grown_sql(name: str, start: str, tree: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT {tree}, lvl + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {name}) WHERE n > 1 GROUP BY {tree}, lvl, pos // 16)"""


OP12_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 5 = 0 AND text IS NOT NULL
              THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql("text")} END AS claim
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM base),
{_grown_sql("nodes", "SELECT source, 0 AS lvl, pos, leaf AS digest FROM leaves", "source")},
subroots AS (SELECT source, arg_max(digest, lvl) AS subroot FROM nodes WHERE pos = 0 GROUP BY source),
tops AS (SELECT 0 AS tree, source, subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM subroots),
{_grown_sql("upper_nodes", "SELECT tree, 0 AS lvl, pos, subroot AS digest FROM tops", "tree")},
{_steps_sql("low", "leaves", "nodes", "source")},
{_steps_sql("high", "tops", "upper_nodes", "tree")},
steps AS (
  SELECT l.source, l.pos, row_number() OVER (PARTITION BY l.source, l.pos ORDER BY s.part, s.lvl) AS k, s.lft, s.rgt
  FROM leaves l JOIN (
    SELECT source, pos, 0 AS part, lvl, lft, rgt FROM low UNION ALL
    SELECT l.source, l.pos, 1, h.lvl, h.lft, h.rgt FROM leaves l JOIN tops t ON t.source IS NOT DISTINCT FROM l.source JOIN high h ON h.pos = t.pos) s
  ON s.source IS NOT DISTINCT FROM l.source AND s.pos = l.pos),
folds AS (
  SELECT source, pos, 0::BIGINT AS k, claim AS node FROM leaves
  UNION ALL
  SELECT f.source, f.pos, s.k, sha256(s.lft || f.node || s.rgt) FROM folds f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos AND s.k = f.k + 1),
folded AS (SELECT source, pos, arg_max(node, k) AS folded_root FROM folds GROUP BY source, pos),
proved AS (SELECT source, pos, string_agg(lft || rgt, '' ORDER BY k) AS proof FROM steps GROUP BY source, pos),
top AS (SELECT arg_max(digest, lvl) AS root FROM upper_nodes WHERE pos = 0)
SELECT l.doc_id, l.leaf, r.subroot, top.root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root, f.folded_root = top.root AS verified
FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source
JOIN folded f ON f.source IS NOT DISTINCT FROM l.source AND f.pos = l.pos
LEFT JOIN proved p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos, top
"""
