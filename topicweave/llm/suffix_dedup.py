"""Removal of repeated byte strings by deep-shallow suffix sorting.

A byte goes when a 200-byte string that covers it also starts anywhere else.

1. Every 200-byte window has one anchor: the smallest hash of its 32-byte
   grams (the rightmost of equal ones).  It depends on the window's content
   only, so equal windows have equal anchors at equal distance.  Consecutive
   windows with one anchor are a run.
2. Runs are counted by anchor hash with map-side sums; an anchor seen once has
   no repeat.  Runs with the same anchor and content hashes are one string of
   the sort, with its number of occurrences; one of them is cut from its text.
3. Deep-shallow sort: the suffixes that begin at the anchors, and the reversed
   prefixes that end there, are ordered by multikey quicksort down to a shallow
   depth, and by a blind trie for each bucket that still ties.  The two orders
   with their common-prefix lengths tell for each window distance which strings
   agree over all 200 bytes; a string that occurs twice agrees with itself.
4. Strings of one anchor that are too many for a task (the edge of a passage
   that a large part of all documents hold) are split by further bytes: the
   window distances are cut into ranges, and strings that can share a window
   of a range agree on the bytes that all its windows hold, which become the
   group's key.  Each string is cut down to what the range sees, so equal ones
   become one string again; a group that is still too large is split once more,
   to single distances, where it is one string.  Every group is then sorted.

Defined cases: null text is empty; texts under 200 bytes lose nothing;
repeated rows are occurrences of their own; strings never cross documents; an
empty table gives no rows; other columns are ignored.  Run and window digests
have 128 bits (64 of the anchor, 64 of the content).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import is_empty, read_table, stage_table, text_or_empty
from topicweave.llm.textscan import BASE_INVERSE, BYTE_CODE, buffer_of, chunked, mix, powers

SPAN = 200
GRAM = 32
PART = 1 << 19  # bytes whose windows are handled at a time
WORD = 16  # bytes that multikey quicksort compares at a time
SHALLOW = 64  # depth at which blind tries take over; all suffixes at an anchor share GRAM bytes
LARGE_GROUP = 20_000  # strings of one group; beyond it the group is split by further bytes
RANGES = (13, 1)  # window distances in a group after the first and the second split
CHUNK = 20_000


def window_runs(buf: np.ndarray, offs: np.ndarray, span: int = SPAN, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor, over all texts of a batch.

    doc, lo (first window's start in its text), wide (windows less one),
    back (anchor minus lo), h (anchor hash), r (hash of the run's bytes).
    """
    parts = []
    width = span - gram + 1
    low = np.uint64((1 << 21) - 1)
    for p in range(0, len(buf), PART):
        bytes_ = buf[p : min(len(buf), p + PART + span - 1)]
        m = len(bytes_) - span + 1
        if m <= 0:
            continue
        # window starts that lie, with the whole window, in one text
        first_doc = int(np.searchsorted(offs, p, "right")) - 1
        last_doc = int(np.searchsorted(offs, p + m, "left"))
        valid = np.zeros(m, bool)
        for d in range(first_doc, last_doc):
            valid[max(0, int(offs[d]) - p) : max(0, int(offs[d + 1]) - p - span + 1)] = True
        if not valid.any():
            continue
        run = np.zeros(len(bytes_) + 1, np.uint64)
        np.cumsum(BYTE_CODE[bytes_] * powers(len(bytes_)), out=run[1:])
        inverse = powers(len(bytes_) + 1, BASE_INVERSE)
        n = len(bytes_) - gram + 1
        grams = mix((run[gram:] - run[:n]) * inverse[:n])
        least = (grams & ~low) | (low - np.arange(n, dtype=np.uint64))
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            rest = width - step
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (low - (least[:m] & low)).astype(np.int64)
        starts = np.flatnonzero(valid)
        a = anchor[starts]
        cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(a) != 0)) + 1
        begin, end = starts[np.concatenate([[0], cut])], starts[np.concatenate([cut, [len(starts)]]) - 1]
        parts.append((begin + p, end + p, anchor[begin] + p, grams[anchor[begin]]))
    if not parts:
        z = np.zeros(0, np.int64)
        return {"doc": z, "lo": z, "wide": z, "back": z, "h": z, "r": z}
    lo, hi, at, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc = np.searchsorted(offs, lo, "right") - 1
    joint = np.flatnonzero((hi[:-1] + 1 == lo[1:]) & (at[:-1] == at[1:]) & (doc[:-1] == doc[1:]))  # cut by a part's end
    if len(joint):
        for j in joint:
            lo[j + 1] = lo[j]
        stay = np.ones(len(lo), bool)
        stay[joint] = False
        lo, hi, at, h, doc = lo[stay], hi[stay], at[stay], h[stay], doc[stay]
    r = np.empty(len(lo), np.uint64)
    for p in range(0, len(buf), PART):  # content hashes, part by part
        sel = np.flatnonzero((lo >= p) & (lo < p + PART))
        if not len(sel):
            continue
        bytes_ = buf[p : int(hi[sel].max()) + span]
        run = np.zeros(len(bytes_) + 1, np.uint64)
        np.cumsum(mix(BYTE_CODE)[bytes_] * powers(len(bytes_)), out=run[1:])
        s, e = lo[sel] - p, hi[sel] - p + span
        r[sel] = mix((run[e] - run[s]) * powers(len(bytes_) + 1, BASE_INVERSE)[s] + (e - s).astype(np.uint64))
    return {"doc": doc, "lo": lo - offs[doc], "wide": hi - lo, "back": at - lo, "h": h.view(np.int64), "r": r.view(np.int64)}


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("uid", F.xxhash64("doc_id", "text"))


def anchored_runs(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, uid, lo, wide, back, h, r: every run of every text."""
    kinds = {"doc_id": pa.int64(), "uid": pa.int64(), "lo": pa.int32(), "wide": pa.int16(), "back": pa.int16(), "h": pa.int64(), "r": pa.int64()}

    def scan(batches):
        for part in chunked(batches):
            runs = window_runs(*buffer_of(part.column(2)), span, gram)
            if len(runs["doc"]):
                take = pa.array(runs["doc"])
                cols = [part.column(0).take(take), part.column(1).take(take)]
                cols += [pa.array(runs[c], pa.int64()).cast(t) for c, t in list(kinds.items())[2:]]
                yield pa.RecordBatch.from_arrays(cols, list(kinds))

    return _keyed(docs).select("doc_id", "uid", "text").mapInArrow(scan, "doc_id long, uid long, lo int, wide smallint, back smallint, h long, r long")


# --- deep-shallow sorting ------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Orders strings by branching bytes alone; each insertion reads one stored
    string to find the place.  The end of a string sorts before any byte."""

    __slots__ = ("strings", "root")

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    # A node is [depth, {byte: child}, any leaf]; a leaf is a list of string numbers.
    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            depth, children, some = node
            node = children.get(s[depth] if depth < len(s) else -1, some)
        other = self.strings[node[0]]
        if other == s:
            node.append(i)
            return
        same = common_prefix(s, other)
        mine, theirs = (s[same] if same < len(s) else -1), (other[same] if same < len(other) else -1)
        parent, node, byte = None, self.root, None
        while isinstance(node, tuple) and node[0] < same:
            byte = s[node[0]] if node[0] < len(s) else -1
            parent, node = node, node[1][byte]
        if isinstance(node, tuple) and node[0] == same:
            node[1][mine] = [i]
            return
        leaf = node
        while isinstance(leaf, tuple):
            leaf = leaf[2]
        fresh = (same, {theirs: node, mine: [i]}, leaf)
        if parent is None:
            self.root = fresh
        else:
            parent[1][byte] = fresh

    def in_order(self) -> tuple[list[int], list[int]]:
        """String numbers in order, and each one's common prefix with the one
        before it (the first: 0)."""
        order: list[int] = []
        shared: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            node, before = stack.pop()
            if isinstance(node, tuple):
                depth, children, _ = node
                keys = sorted(children, reverse=True)
                for k in keys:
                    stack.append((children[k], before if k == keys[-1] else depth))
            else:
                size = len(self.strings[node[0]])
                for k, i in enumerate(node):
                    order.append(i)
                    shared.append(before if k == 0 else size)
        return order, shared


def multikey_quicksort(strings: list[bytes], numbers: list[int], shallow: int = SHALLOW) -> Iterator[list[int]]:
    """String numbers in order, as buckets: one string, or several that agree
    on ``shallow`` bytes or to their ends."""
    stack = [(numbers, 0)]
    while stack:
        bucket, depth = stack.pop()
        if len(bucket) == 1 or depth >= shallow:
            yield bucket
            continue
        keys = [strings[i][depth : depth + WORD] for i in bucket]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less, same, more = [], [], []
        for i, k in zip(bucket, keys, strict=True):
            (same if k == pivot else less if k < pivot else more).append(i)
        # a short pivot is the end of the strings: they are equal
        parts = ((more, depth), (same, depth + WORD if len(pivot) == WORD else shallow), (less, depth))
        stack += [part for part in parts if part[0]]


def deep_shallow(strings: list[bytes], group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``strings`` within ``group`` and each one's common prefix with
    the one before it (-1 where a group begins)."""
    by_group = np.argsort(group, kind="stable")
    bounds = np.flatnonzero(np.diff(group[by_group], prepend=-1, append=-1))
    order: list[int] = []
    shared: list[int] = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        begin = len(order)
        for bucket in multikey_quicksort(strings, by_group[a:b].tolist(), shallow):
            lengths = [0]
            if len(bucket) > 1:
                trie = BlindTrie(strings)
                for i in bucket:
                    trie.insert(i)
                bucket, lengths = trie.in_order()
            lengths[0] = common_prefix(strings[order[-1]], strings[bucket[0]]) if len(order) > begin else -1
            order += bucket
            shared += lengths
    return np.array(order, np.int64), np.array(shared, np.int64)


def repeated_distances(group: np.ndarray, left: list[bytes], right: list[bytes], lo: np.ndarray, hi: np.ndarray, n: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For each string and each distance of window start to anchor (``lo`` to
    ``hi`` are its own): does the window occur twice?

    ``left`` are the reversed prefixes that end at the anchor, ``right`` the
    suffixes that begin there, ``n`` the strings' occurrences.
    """
    orders = [deep_shallow(side, group) for side in (right, left)]
    rank = []
    for order, _ in orders:
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rank.append(place)
    far = int(hi.max()) if len(hi) else 0
    distances = np.arange(far + 1)
    own = (lo[:, None] <= distances) & (distances <= hi[:, None])
    repeated = own & (n > 1)[:, None]
    sizes = np.bincount(group)
    several = sizes[group] > 1
    for d in range(far + 1):
        live = np.flatnonzero(own[:, d] & several)
        if len(live) < 2:
            continue
        # strings between which no common prefix is shorter than the window's part
        same_right = np.cumsum(orders[0][1] < span - d)[rank[0][live]]
        same_left = np.cumsum((orders[1][1] < d) | (orders[1][1] < 0))[rank[1][live]]
        key = same_right * np.int64(len(group) + 1) + same_left
        by = np.argsort(key, kind="stable")
        twin = key[by][1:] == key[by][:-1]
        hit = np.zeros(len(live), bool)
        hit[1:] |= twin
        hit[:-1] |= twin
        repeated[live[by[hit]], d] = True
    return repeated


ITEM = {"id": pa.binary(), "key": pa.binary(), "n": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "left": pa.binary(), "right": pa.binary()}
ITEM_SCHEMA = "id binary, key binary, n long, lo int, hi int, left binary, right binary"
FOUND_SCHEMA = "id binary, found array<struct<a:int,b:int>>"


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))


def sorted_repeats(items: DataFrame, span: int = SPAN) -> DataFrame:
    """The sort's verdict on ``items`` (strings, see ``ITEM``), grouped by key:
    id and the ranges of distances at which the string's windows repeat."""

    def verdicts(held: dict[str, list]) -> pa.RecordBatch:
        keys = held["key"]
        group = np.cumsum([0] + [a != b for a, b in zip(keys[:-1], keys[1:], strict=True)]).astype(np.int64)
        numbers = {c: np.asarray(held[c], np.int64) for c in ("lo", "hi", "n")}
        grid = np.zeros((len(keys), int(numbers["hi"].max()) + 3), np.int8)
        grid[:, 1:-1] = repeated_distances(group, held["left"], held["right"], numbers["lo"], numbers["hi"], numbers["n"], span)
        edge = np.diff(grid, axis=1)
        row, first = np.nonzero(edge == 1)
        _, beyond = np.nonzero(edge == -1)
        found: dict[int, list] = {}
        for i, a, b in zip(row.tolist(), first.tolist(), beyond.tolist(), strict=True):
            found.setdefault(i, []).append({"a": a, "b": b - 1})
        kinds = {"id": pa.binary(), "found": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))}
        return _batch([(held["id"][i], ranges) for i, ranges in found.items()], kinds)

    def sort_groups(batches):
        held: dict[str, list] = {c: [] for c in ITEM}
        for batch in batches:
            for c in ITEM:
                held[c].extend(batch.column(c).to_pylist())
            if len(held["key"]) >= CHUNK:  # all but the last, perhaps unfinished group
                to = len(held["key"])
                while to and held["key"][to - 1] == held["key"][-1]:
                    to -= 1
                if to:
                    yield verdicts({c: v[:to] for c, v in held.items()})
                    held = {c: v[to:] for c, v in held.items()}
        if held["key"]:
            yield verdicts(held)

    return items.select(*ITEM).repartition("key").sortWithinPartitions("key").mapInArrow(sort_groups, FOUND_SCHEMA)


def split_groups(items: DataFrame, width: int, span: int = SPAN) -> DataFrame:
    """Items of too large groups, by ranges of ``width`` window distances:
    ``parent`` and the columns of ``ITEM``.

    Windows at distances a to b hold the a bytes before the anchor and the
    span - b bytes behind it; strings that differ there share none of them.
    """
    kinds = {"parent": pa.binary(), **ITEM}

    def split(batches):
        for batch in chunked(batches):
            rows = []
            for x in batch.to_pylist():
                for a in range(x["lo"] // width * width, x["hi"] + 1, width):
                    b = a + width - 1
                    lo, hi = max(a, x["lo"]), min(b, x["hi"])
                    core = b"%s:%d:%s:%s" % (x["key"], a, x["left"][:a], x["right"][: max(0, span - b)])
                    key = hashlib.blake2b(core, digest_size=16).digest()
                    left, right = x["left"][:hi], x["right"][: span - lo]
                    own = hashlib.blake2b(b"%s:%d:%d:%s:%s" % (key, lo, hi, left, right), digest_size=16).digest()
                    rows.append((x["id"], own, key, x["n"], lo, hi, left, right))
            yield _batch(rows, kinds)

    return items.select(*ITEM).mapInArrow(split, f"parent binary, {ITEM_SCHEMA}")


def repeats(items: DataFrame, span: int = SPAN, large: int = LARGE_GROUP, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """``sorted_repeats``, with groups of more than ``large`` strings split."""
    crowds = items.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > large).select("key")
    crowds = stage_table(crowds, "suffix-crowds")
    if not ranges or is_empty(crowds):
        return sorted_repeats(items, span)
    found = sorted_repeats(items.join(crowds, "key", "left_anti"), span)
    parts = stage_table(split_groups(items.join(crowds, "key", "left_semi"), ranges[0], span), "suffix-parts")
    # equal strings of a group are one string again
    same = [c for c in ITEM if c != "n"]
    fewer = stage_table(parts.groupBy(*same).agg(F.sum("n").alias("n")).select(*ITEM), "suffix-items")
    below = stage_table(repeats(fewer, span, large, ranges[1:]), "suffix-below")
    told = parts.select("parent", "id").join(below, "id").groupBy("parent").agg(F.flatten(F.collect_list("found")).alias("found"))
    return found.unionByName(told.select(F.col("parent").alias("id"), "found"))


def cut_items(docs: DataFrame, kinds: DataFrame, span: int = SPAN) -> DataFrame:
    """The strings of ``kinds`` (h, r, n and one occurrence), cut from the texts."""

    def cut(batches):
        for batch in chunked(batches, 200):
            rows = []
            for text, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for c in cuts:
                    at = c["lo"] + c["back"]
                    key = c["h"].to_bytes(8, "big", signed=True)
                    rows.append(
                        (key + c["r"].to_bytes(8, "big", signed=True), key, c["n"], c["back"] - c["wide"], c["back"],
                         text[c["lo"] : at][::-1], text[at : c["lo"] + c["wide"] + span])
                    )
            yield _batch(rows, ITEM)

    # as many as one text has runs
    by_doc = kinds.groupBy(F.col("doc_id").alias("c_id"), F.col("uid").alias("c_uid")).agg(F.collect_list(F.struct("h", "r", "n", "lo", "wide", "back")).alias("cuts"))
    keyed = _keyed(docs).select("doc_id", "uid", F.col("text").cast("binary").alias("text"))
    held = keyed.join(by_doc, keyed["doc_id"].eqNullSafe(by_doc["c_id"]) & (keyed["uid"] == by_doc["c_uid"]))
    # repeated rows cut the same strings
    return held.select("text", "cuts").mapInArrow(cut, ITEM_SCHEMA).dropDuplicates(["id"])


def removal_spans(spark: SparkSession, docs: DataFrame, span: int = SPAN, gram: int = GRAM, large: int = LARGE_GROUP) -> DataFrame:
    """doc_id, uid, text, spans (s, e of byte ranges, not yet merged) of the
    documents that lose something."""
    runs = anchored_runs(docs, span, gram)
    seen = runs.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("t_h"))
    twice = stage_table(seen, "suffix-anchors")
    again = stage_table(runs.join(twice, runs["h"] == twice["t_h"]).drop("t_h"), "suffix-runs")
    one = F.min(F.struct("uid", "lo", "doc_id", "wide", "back"))
    kinds = again.groupBy("h", "r").agg(F.count("*").alias("n"), one.alias("one")).select("h", "r", "n", "one.*")
    items = stage_table(cut_items(docs, kinds, span), "suffix-items")
    part = lambda at: F.conv(F.hex(F.substring("id", at, 8)), 16, -10).cast("long")
    found = stage_table(repeats(items, span, large).select(part(1).alias("f_h"), part(9).alias("f_r"), "found"), "suffix-found")
    told = again.join(found, (F.col("h") == F.col("f_h")) & (F.col("r") == F.col("f_r")))
    at = F.col("lo").cast("long") + F.col("back")
    places = F.transform("found", lambda x: F.struct((at - x["b"]).alias("s"), (at - x["a"] + span).alias("e")))
    by_doc = told.select("doc_id", "uid", places.alias("spans")).groupBy(F.col("doc_id").alias("m_id"), F.col("uid").alias("m_uid")).agg(F.flatten(F.collect_set("spans")).alias("spans"))
    keyed = _keyed(docs)
    return keyed.join(by_doc, keyed["doc_id"].eqNullSafe(by_doc["m_id"]) & (keyed["uid"] == by_doc["m_uid"])).select(
        "doc_id", "uid", F.col("text").cast("binary").alias("text"), "spans"
    )


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def removed_repeats(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Documents that lose something: doc_id, uid, removed (merged byte
    ranges) and kept (the remaining bytes).  Repeated rows give one row."""

    def cut_out(batches):
        for batch in chunked(batches):
            removed, kept = [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                gone = merged_spans([(x["s"], x["e"]) for x in spans])
                edges = [0, *(y for x in gone for y in x), len(text)]
                removed.append([{"s": s, "e": e} for s, e in gone])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, kind), pa.array(kept, pa.binary())], ["doc_id", "uid", "removed", "kept"]
            )

    rows = removal_spans(spark, docs, **options).dropDuplicates(["doc_id", "uid"])
    return rows.mapInArrow(cut_out, "doc_id long, uid long, removed array<struct<s:bigint,e:bigint>>, kept binary")


def op3_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    cut = removed_repeats(spark, docs).select(
        F.col("doc_id").alias("c_id"), F.col("uid").alias("c_uid"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    cut = stage_table(cut, "suffix-report")
    rows = _keyed(docs).select("doc_id", "uid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("full"))
    return rows.join(cut, rows["doc_id"].eqNullSafe(cut["c_id"]) & (rows["uid"] == cut["c_uid"]), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "full").alias("kept_sha256"),
    )
