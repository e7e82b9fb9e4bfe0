"""Jaccard self-join on word shingles: a grouped prefix join.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of at least 0.8.  Rarest shingles first, a linked pair shares one
of its first ``n - ceil(0.8 n) + 1`` shingles (its prefix).  Rarity comes from
a sketch of all shingle counts, sized by the corpus; any order gives right
results, so the sketch's error costs time only.

* Equal sets are one class.  Classes with the same prefix and size are one
  group, and only groups are posted under their prefix shingles.
* First round: each posting list links its entries to the entry with fewest
  rarer shingles (a cluster's original) and to the neighbour in size; these
  few pairs, where the prefixes share enough, are verified, and their
  components found.
* Second round: posting entries are expanded to their members, and every pair
  of different components that passes the size, position and count filters
  is verified.  So nothing is lost, and a large cluster of near copies does not
  cost all of its pairs.
* No list is held whole.  One of more than ``HOT_LIST`` entries is dealt out:
  its neighbours in size are taken part by part, its hub is an aggregate, and
  in the second round a task holds one block of it, past which the entries
  outside its largest component stream.

Defined cases: A-Z is lower-cased, words are runs without white space; fewer
than five words count as one shingle; null and empty texts have an empty set
and link with nothing; repeated rows and equal sets are linked; an empty table
gives no rows; a null id is no component's name while another id is there;
other columns are ignored by the join and kept by ``kept_documents``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.llm.common import is_empty, read_table, small_batches, stage_table, text_or_empty
from topicweave.llm.components import connected_components
from topicweave.llm.textscan import LOWER, SHINGLE_CODE, buffer_of, chunked, mix, slices, windows, word_hashes, words

SHINGLE = 5
NUMERATOR, DENOMINATOR = 80, 100  # similarity at least 80 / 100
SKETCH_BITS = 21  # at least; see sketch_bits
MOST_SKETCH_BITS = 27
BYTES_A_COUNTER = 256  # of stored text
UNKNOWN_BYTES = 1 << 60  # Spark's default for a size that it cannot estimate is larger
SKETCH_BLOCK = 1 << 15
FILTER_BITS = 24
PAIRS_PER_SALT = 2000
HOT_LIST = 100_000  # entries; a longer posting list is dealt out in parts of this size
MEET_AT_ONCE = 1 << 18  # comparisons made at a time


def shingle_sets(texts: pa.Array, k: int = SHINGLE):
    """The sorted distinct shingle hashes of every text, one array each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for a, b in slices(texts):
        buf, offs = buffer_of(texts.slice(a, b - a))
        buf = LOWER[buf]
        starts, ends, bounds = words(buf, offs)
        hashes = word_hashes(buf, starts, ends)
        shingle, _, doc = windows(hashes, bounds, k)
        cut = np.searchsorted(doc, np.arange(b - a + 1))
        for i in range(b - a):
            n = bounds[i + 1] - bounds[i]
            if n >= k:
                yield np.unique(shingle[cut[i] : cut[i + 1]])
            elif n:  # the whole sequence; the number of words keeps it apart from shingles
                few = hashes[bounds[i] : bounds[i + 1]]
                yield mix((few * SHINGLE_CODE[8 : 8 + n]).sum(keepdims=True) + SHINGLE_CODE[16 + n])
            else:
                yield np.zeros(0, np.uint64)


def prefix_length(n: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> int:
    return n - -(-num * n // den) + 1


def count_sketch(df: DataFrame, hashes_of, bits: int, marks: bool = False) -> np.ndarray:
    """How many hashes fall on each of 2**bits counters (saturating); with
    ``marks`` only whether one does, in a byte each.

    ``hashes_of(batch)`` gives the hashes of one Arrow batch.  Each task sends
    its counters in compressed blocks, and the blocks are summed as streams in
    two steps, so that no task receives every task's counters; the result's
    size is fixed by ``bits``.
    """
    size = 1 << bits
    blocks = max(1, size // SKETCH_BLOCK)
    kind = np.uint8 if marks else np.uint32

    def packed(i, part):
        raw = zlib.compress(part.tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([raw], pa.binary())], ["block", "counts"])

    def count(batches):
        table = np.zeros(size, kind)
        for batch in chunked(batches):
            at = (hashes_of(batch) >> np.uint64(64 - bits)).astype(np.int64)
            if marks:
                table[at] = 1
            elif len(at):
                table += np.bincount(at, minlength=size).astype(np.uint32)
        for i, part in enumerate(np.split(table, blocks)):
            if part.any():
                yield packed(i, part)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(raw), kind)
                if i in sums:  # a sum that would pass the type's end stays at it
                    part = np.maximum(sums[i], part) if marks else sums[i] + np.minimum(part, ~sums[i])
                sums[i] = part
        for i, part in sums.items():
            yield packed(i, part)

    shape = "block int, counts binary"
    parts = df.mapInArrow(count, shape).withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(16)))
    once = parts.repartition("block", "salt").select("block", "counts").mapInArrow(add, shape)
    table, width = np.zeros(size, kind), size // blocks
    with small_batches(df.sparkSession):
        summed = once.repartition("block").mapInArrow(add, shape).collect()  # 2**bits counters, compressed
    for row in summed:
        table[row["block"] * width : (row["block"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), kind)
    return table


def sketch_bits(docs: DataFrame) -> int:
    """Counters (as a power of two) for the corpus's size as Spark's plan
    estimates it; nothing is run.  The sketch, and the byte a counter that is
    broadcast, grow with the corpus up to 2**27 (128 MB); beyond it shingles
    share counters more often, which costs time only.  An unknown size (rows
    that come from no table) takes the least."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= UNKNOWN_BYTES:
        return SKETCH_BITS
    return max(SKETCH_BITS, min(MOST_SKETCH_BITS, (size // BYTES_A_COUNTER).bit_length()))


def shingle_sketch(docs: DataFrame, bits: int | None = None, k: int = SHINGLE) -> np.ndarray:
    """Counts of all documents' shingles."""
    bits = bits or sketch_bits(docs)

    def hashes(batch):
        return np.concatenate([np.zeros(0, np.uint64), *shingle_sets(batch.column(0), k)])

    return count_sketch(docs.select("text"), hashes, bits)


def key_hashes(keys: pa.Array) -> np.ndarray:
    return mix(keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


SIGNATURE = "doc_id long, text_key long, n int, d1 long, d2 long, prefix_key long, prefix array<bigint>"


def signatures(docs: DataFrame, sketch: np.ndarray, k: int = SHINGLE) -> DataFrame:
    """One row per document: set size, set digest, and the prefix in order."""
    bits = int(sketch.size).bit_length() - 1
    # log2 classes are enough to order by rarity, in a quarter of the space
    rarity = np.minimum(np.log2(sketch + 1.0) * 8, 255).astype(np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(rarity)
    salt = np.uint64(0xD6E8FEB86659FD93)

    def sign(batches):
        order_by = shared.value
        for batch in chunked(batches):
            n, d1, d2, key, prefix = [], [], [], [], []
            for s in shingle_sets(batch.column(2), k):
                n.append(len(s))
                d1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                d2.append(int(mix(s ^ salt).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                p = prefix_length(len(s)) if len(s) else 0
                first = s[np.argsort(order_by[(s >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")[:p]]
                with np.errstate(over="ignore"):
                    weights = np.arange(1, 2 * p, 2, dtype=np.uint64)
                    key.append(int(mix((mix(first) * weights).sum(keepdims=True) + np.uint64(len(s)))[0].view(np.int64)))
                prefix.append(first.view(np.int64))
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in prefix])]).astype(np.int32)
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            cols = [
                batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                pa.array(key, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(flat, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_key", "n", "d1", "d2", "prefix_key", "prefix"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(sign, SIGNATURE)


def _long_enough(a, b):
    """Sizes that allow the similarity."""
    return (F.lit(DENOMINATOR) * F.least(a, b)) >= (F.lit(NUMERATOR) * F.greatest(a, b))


def _position_allows(n1, p1, n2, p2):
    """The most the sets can share if this is their first common shingle."""
    most = 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    # overlap >= s / (1 + s) * (n1 + n2), in whole numbers
    return most * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (n1 + n2)


def postings(groups: DataFrame, hot: int = HOT_LIST) -> DataFrame:
    """token, gid, n, pos, part, parts: entries that have a partner of fitting size.

    A list of more than ``hot`` entries has several parts, drawn by group; all
    of its entries stay, as a part does not show every partner.  The table of
    such lists has at most one row for ``hot`` entries and is broadcast.
    """
    rows = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    listed = rows.groupBy("token").agg(F.count("*").alias("listed")).where(F.col("listed") > hot)
    listed = stage_table(listed.select("token", F.ceil(F.col("listed") / hot).cast("int").alias("parts")), "jaccard-hot")
    rows = rows.join(F.broadcast(listed), "token", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("gid"), F.col("parts")).cast("int"))
    along = Window.partitionBy("token", "part").orderBy("n", "gid")
    before, after = F.lag("n").over(along), F.lead("n").over(along)
    near = rows.withColumn("before", before).withColumn("after", after)
    return near.where(
        (F.col("parts") > 1)
        | (F.col("before") * DENOMINATOR >= F.col("n") * NUMERATOR)
        | (F.col("n") * DENOMINATOR >= F.col("after") * NUMERATOR)
    ).select("token", "gid", "n", "pos", "part", "parts")


def sparse_pairs(posted: DataFrame) -> DataFrame:
    """First round: each entry with its list's hub and with its neighbour in
    size (in its part of a list in several parts, whose hub is an aggregate)."""
    hub = Window.partitionBy("token", "part").orderBy("pos", "gid")
    by_size = Window.partitionBy("token", "part").orderBy("n", "gid")
    top = posted.where("parts > 1").groupBy("token").agg(F.min(F.struct("pos", "gid", "n")).alias("top"))
    top = top.select("token", F.struct("top.gid", "top.n", "top.pos").alias("top"))  # a row for each long list
    rows = posted.select(
        "token", "gid", "n", "pos",
        F.first(F.struct("gid", "n", "pos")).over(hub).alias("first"),
        F.lag(F.struct("gid", "n", "pos")).over(by_size).alias("near"),
    ).join(F.broadcast(top), "token", "left").withColumn("hub", F.coalesce("top", "first"))

    def pairs(other: str) -> DataFrame:
        o = F.col(other)
        fits = _long_enough(F.col("n"), o["n"]) & _position_allows(F.col("n"), F.col("pos"), o["n"], o["pos"])
        return rows.where((o["gid"] != F.col("gid")) & fits).select(
            F.least("gid", o["gid"]).alias("a"), F.greatest("gid", o["gid"]).alias("b")
        )

    return pairs("hub").unionByName(pairs("near")).distinct()


def _enough_common(common, n1, last1, n2, last2):
    """Can sets with ``common`` shared prefix shingles, the last of them at
    positions ``last1`` and ``last2``, be similar?

    One of the two prefixes ends first in the common order.  What the sets
    share beyond its end lies in that set's rest, and in the other set behind
    the last shared shingle.
    """
    rest = lambda n: F.floor((NUMERATOR * n + DENOMINATOR - 1) / DENOMINATOR) - 1  # noqa: E731  n less its prefix
    beyond = F.greatest(F.least(rest(n1), n2 - last2 - 1), F.least(rest(n2), n1 - last1 - 1))
    return (common + beyond) * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (n1 + n2)


SHARED = ("n1", "last1", "n2", "last2")


def plausible(pairs: DataFrame, posted: DataFrame) -> DataFrame:
    """The pairs (a, b) of groups that share enough of their prefixes.

    ``posted`` has every common prefix shingle of two groups of fitting size.
    """
    left = posted.select(F.col("gid").alias("a"), "token", F.col("n").alias("n1"), F.col("pos").alias("pos1"))
    right = posted.select(F.col("gid").alias("b"), "token", F.col("n").alias("n2"), F.col("pos").alias("pos2"))
    shared = pairs.join(left, "a").join(right, ["b", "token"]).groupBy("a", "b").agg(
        F.count("*").alias("common"), F.first("n1").alias("n1"), F.max("pos1").alias("last1"), F.first("n2").alias("n2"), F.max("pos2").alias("last2")
    )
    return shared.where(_enough_common(F.col("common"), *map(F.col, SHARED))).select("a", "b")


def open_pairs(entries: DataFrame, hot: int = HOT_LIST) -> DataFrame:
    """Second round: all pairs of one posting list that lie in different
    components and pass the size and position filters: a, b and their groups
    ga, gb.  ``entries``: token, gid, cid, n, pos, comp.

    Lists within one component are dropped before; the rest are read in order
    of size, so an entry meets only entries of fitting size.  A list of more
    than ``hot`` entries goes to ``block_pairs``; there is at most one of them
    for ``hot`` entries, so their names are broadcast.
    """
    sums = entries.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("listed"))
    several = stage_table(sums.where("lo != hi").select("token", "listed"), "jaccard-several")
    long = several.where(F.col("listed") > hot)
    if is_empty(long):
        return _list_pairs(entries.join(several, "token", "left_semi")).distinct()
    few = several.where(F.col("listed") <= hot)
    # The short lists alone meet in a shuffle by token.
    short = entries.join(F.broadcast(long), "token", "left_anti").join(few, "token", "left_semi")
    return _list_pairs(short).unionByName(block_pairs(entries, long, hot)).distinct()


def block_pairs(entries: DataFrame, long: DataFrame, block: int) -> DataFrame:
    """The pairs of ``open_pairs`` for the lists in ``long`` (token, listed).

    Each list is dealt out in blocks of about ``block`` entries.  Entries of its
    largest component need not meet each other, so only the others ask: an
    asking entry goes to every block, and a task holds one block.
    """
    rows = stage_table(entries.join(F.broadcast(long), "token"), "jaccard-long")
    held = rows.groupBy("token", "comp").agg(F.count("*").alias("held"))
    top = held.groupBy("token").agg(F.max(F.struct("held", "comp"))["comp"].alias("top"))
    blocks = F.ceil(F.col("listed") / block).cast("int")
    rows = rows.join(F.broadcast(top), "token").select(
        "token", "gid", "cid", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"), "comp",
        (F.col("comp") != F.col("top")).alias("asks"), blocks.alias("blocks"),
    )
    fields = ["gid", "cid", "n", "pos", "comp", "asks"]
    keys = ["token", "block", "kind"]
    home = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    stored = rows.select("token", home.alias("block"), F.lit(0).alias("kind"), *fields)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = rows.where("asks").select("token", every.alias("block"), F.lit(1).alias("kind"), *fields)
    dealt = stored.unionByName(asking).repartition("token", "block").sortWithinPartitions(*keys, "n")

    def meet(batches):
        at, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, *fields)}
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([cols[c][1:] != cols[c][:-1] for c in keys], axis=0)
            bounds = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                where = (cols["token"][lo], cols["block"][lo])
                part = {c: cols[c][lo:hi] for c in fields}
                if cols["kind"][lo] == 0:
                    held = {c: np.concatenate([held[c], part[c]]) for c in fields} if where == at else part
                    at = where
                elif where == at:  # else the block is empty
                    yield from _met(part, held)

    return dealt.mapInArrow(meet, PAIRS)


def _met(asking: dict, held: dict):
    """Pairs of asking entries with a block's entries (sorted by size), a
    bounded number of comparisons at a time."""
    first = np.searchsorted(held["n"], -(-asking["n"] * NUMERATOR // DENOMINATOR), "left")
    last = np.searchsorted(held["n"], asking["n"] * DENOMINATOR // NUMERATOR, "right")
    ends, begin = np.cumsum(last - first), 0
    while begin < len(ends):
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + MEET_AT_ONCE, "right")))
        width = (last - first)[begin:end]
        i = np.repeat(np.arange(begin, end), width)
        j = np.arange(len(i)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first[begin:end], width)
        a, b = {c: asking[c][i] for c in asking}, {c: held[c][j] for c in held}
        most = 1 + np.minimum(a["n"] - a["pos"] - 1, b["n"] - b["pos"] - 1)
        # two asking entries meet twice; the smaller one reports
        ok = (a["comp"] != b["comp"]) & (~b["asks"] | (a["cid"] < b["cid"]))
        ok &= most * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (a["n"] + b["n"])
        if ok.any():
            a, b = {c: a[c][ok] for c in a}, {c: b[c][ok] for c in b}
            low = a["cid"] < b["cid"]
            cols = [np.where(low, x, y) for x, y in ((a["cid"], b["cid"]), (b["cid"], a["cid"]), (a["gid"], b["gid"]), (b["gid"], a["gid"]))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "ga", "gb"])
        begin = end


PAIRS = "a long, b long, ga long, gb long"


def _list_pairs(entries: DataFrame) -> DataFrame:
    """The pairs of ``open_pairs`` for lists that a task can hold."""
    rows = entries.repartition("token").sortWithinPartitions("token", "n", "cid")

    def pair_up(batches):
        carry = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("token", "cid", "n", "pos", "comp", "gid")]
            if carry is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(carry, cols, strict=True)]
            if not len(cols[0]):
                continue
            last = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            carry = [c[last:] for c in cols]
            if last:
                yield from emit([c[:last] for c in cols])
        if carry is not None:
            yield from emit(carry)

    def emit(cols):
        token, cid, n, pos, comp, gid = cols
        # In each list the largest component's entries need not meet each other:
        # only the rest look for partners, behind them and, in the largest, before.
        run = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]]))
        by = np.lexsort((comp, run))
        new = np.concatenate([[True], (run[by][1:] != run[by][:-1]) | (comp[by][1:] != comp[by][:-1])])
        block = np.cumsum(new) - 1
        size = np.bincount(block)[block]
        top = np.zeros(run[-1] + 1, np.int64)
        np.maximum.at(top, run[by], size * np.int64(len(by) + 1) + block)
        largest = np.empty(len(by), bool)
        largest[by] = block == top[run[by]] % (len(by) + 1)
        for step in (1, -1):
            at, lag = np.flatnonzero(~largest), step
            while len(at):
                at = at[(at + lag < len(token)) & (at + lag >= 0)]
                to = at + lag
                low, high = np.minimum(n[at], n[to]), np.maximum(n[at], n[to])
                at = at[(token[at] == token[to]) & (low * DENOMINATOR >= high * NUMERATOR)]
                to = at + lag
                most = 1 + np.minimum(n[at] - pos[at] - 1, n[to] - pos[to] - 1)
                ok = (comp[at] != comp[to]) & (most * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (n[at] + n[to]))
                if step < 0:
                    ok &= largest[to]
                if ok.any():
                    i, j = at[ok], to[ok]
                    i, j = np.where(cid[i] < cid[j], i, j), np.where(cid[i] < cid[j], j, i)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cid[i], cid[j], gid[i], gid[j])], ["a", "b", "ga", "gb"])
                lag += step

    whole = rows.select("token", "cid", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"), "comp", "gid")
    return whole.mapInArrow(pair_up, PAIRS)


def candidate_sets(docs: DataFrame, wanted: DataFrame, k: int = SHINGLE, bits: int = FILTER_BITS) -> DataFrame:
    """cid, tokens: the shingle sets of the wanted classes' first documents.

    ``wanted``: cid, doc_id, text_key, a written table.  A table of 2**bits
    marks over the wanted keys, the same size for any corpus, keeps most other
    texts out of the shuffle; what it lets through by chance, the join drops.
    """
    marked = np.packbits(count_sketch(wanted.select("text_key"), lambda batch: key_hashes(batch.column(0)), bits, marks=True))
    shared = docs.sparkSession.sparkContext.broadcast(marked)
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))

    def sets(batches):
        bitmap = shared.value
        for batch in chunked(batches):
            at = (key_hashes(batch.column(1)) >> np.uint64(64 - bits)).astype(np.int64)
            batch = batch.filter(pa.array((bitmap[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)))
            tokens = [s.tobytes() for s in shingle_sets(batch.column(2), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.binary())], ["doc_id", "text_key", "tokens"])

    near = rows.mapInArrow(sets, "doc_id long, text_key long, tokens binary")
    w = wanted.select("cid", F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key"))
    found = near.join(w, near["doc_id"].eqNullSafe(w["w_id"]) & (near["text_key"] == w["w_key"]))
    return found.select("cid", "tokens").dropDuplicates(["cid"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity.

    A class with very many pairs is spread: its pairs over salts, its set
    copied to each of them.
    """
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("salts"))
    right = pairs.join(salts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt")
    ).join(sets.select(F.col("cid").alias("b"), "tokens"), "b").select("a", "salt", F.lit(1).alias("kind"), "b", "tokens")
    left = sets.join(salts, sets["cid"] == salts["a"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("b"), "tokens"
    )
    ordered = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")

    def check(batches):
        own_id, own = None, np.zeros(0, np.uint64)
        for batch in chunked(batches):
            a_ids, b_ids = [], []
            for a, kind, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "kind", "b", "tokens")), strict=True):
                s = np.frombuffer(raw, np.uint64)
                if kind == 0:
                    own_id, own = a, s
                elif own_id == a:
                    at = np.searchsorted(own, s)
                    at[at == len(own)] = 0
                    both = int((own[at] == s).sum()) if len(own) else 0
                    if DENOMINATOR * both >= NUMERATOR * (len(own) + len(s) - both):
                        a_ids.append(a)
                        b_ids.append(b)
            if a_ids:
                yield pa.RecordBatch.from_arrays([pa.array(a_ids, pa.int64()), pa.array(b_ids, pa.int64())], ["u", "v"])

    return ordered.mapInArrow(check, "u long, v long")


def shingle_components(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, hot: int = HOT_LIST) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, keep.

    Posting lists of more than ``hot`` entries are dealt out in parts.
    ``keep`` marks the rows of the component's first document (all documents
    without words; repeated rows share the mark).
    """
    sketch = shingle_sketch(docs, k=k)
    signed = stage_table(signatures(docs, sketch, k).withColumn("row_no", F.monotonically_increasing_id()), "jaccard-signatures")
    sized = signed.where("n > 0")
    # Classes of equal sets, numbered by their first row (small id first, null ids last).
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "row_no"))
    classes = sized.groupBy("n", "d1", "d2").agg(first.alias("first"), F.first("prefix_key").alias("prefix_key")).select(
        "n", "d1", "d2", "prefix_key", F.col("first.row_no").alias("cid"), F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key")
    )
    classes = stage_table(classes, "jaccard-classes")
    group_of = classes.groupBy("n", "prefix_key").agg(F.min("cid").alias("gid"))
    groups = group_of.join(sized.select(F.col("row_no").alias("gid"), "prefix"), "gid").select("gid", "n", "prefix")
    posted = stage_table(postings(groups, hot), "jaccard-postings")
    members = stage_table(classes.join(group_of, ["n", "prefix_key"]).select("gid", "cid", "doc_id", "text_key"), "jaccard-members")
    crowded = members.groupBy("gid").agg(F.count("*").alias("m")).where("m > 1").select("gid")

    def links(pairs: DataFrame, round_: int) -> DataFrame:
        """Verify pairs on the sets of the classes that they name."""
        pairs = stage_table(pairs, f"jaccard-pairs-{round_}")
        named = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        wanted = stage_table(classes.join(named, "cid", "left_semi").select("cid", "doc_id", "text_key"), f"jaccard-wanted-{round_}")
        sets = stage_table(candidate_sets(docs, wanted, k), f"jaccard-sets-{round_}")
        return stage_table(verified(pairs, sets), f"jaccard-links-{round_}")

    within = members.where("cid != gid").select(F.col("gid").alias("a"), F.col("cid").alias("b"))
    near = links(plausible(sparse_pairs(posted), posted).unionByName(within).distinct(), 1)
    known = connected_components(near, "jaccard-near")
    labelled = members.join(known, members["cid"] == known["node"], "left").select(
        "gid", "cid", F.coalesce("component", "cid").alias("comp")
    )
    # A crowded group's members meet under the group's first shingle as well.
    alone = groups.join(crowded, "gid", "left_semi").select(F.element_at("prefix", 1).alias("token"), "gid", "n", F.lit(0).alias("pos"))
    entries = posted.select("token", "gid", "n", "pos").unionByName(alone).distinct().join(labelled, "gid").select("token", "gid", "cid", "n", "pos", "comp")
    met = stage_table(open_pairs(entries, hot), "jaccard-met")
    # Pairs of groups, smaller first, whose prefixes share enough.
    by_group = met.select(F.least("ga", "gb").alias("a"), F.greatest("ga", "gb").alias("b")).where("a != b").distinct()
    sound = plausible(by_group, posted).select(F.col("a").alias("sa"), F.col("b").alias("sb"))
    apart = met.join(sound, (F.least("ga", "gb") == F.col("sa")) & (F.greatest("ga", "gb") == F.col("sb")), "left_semi")
    far = links(apart.unionByName(met.where("ga = gb")).select("a", "b"), 2)
    parts = connected_components(near.unionByName(far), "jaccard-all")
    heads = classes.join(parts, classes["cid"] == parts["node"], "left").select(
        "n", "d1", "d2", "cid", "doc_id", "text_key", F.coalesce("component", "cid").alias("comp")
    )
    best = heads.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("best"))
    heads = stage_table(heads.join(best, "comp").select("n", "d1", "d2", F.col("best.doc_id").alias("component_id"), F.col("best.text_key").alias("keep_key")), "jaccard-heads")
    rows = sized.select("doc_id", "text_key", "n", "d1", "d2").join(heads, ["n", "d1", "d2"]).select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), "component_id",
        (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("keep_key"))).alias("keep"),
    )
    empty = signed.where("n = 0").select("doc_id", "text_key", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("keep"))
    return rows.unionByName(empty)


def kept_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each component, and every document without words."""
    keep = stage_table(
        shingle_components(spark, docs).where("keep").select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_key"), (F.col("n_shingles") == 0).alias("bare")).distinct(),
        "jaccard-keep",
    )
    text = text_or_empty()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("d_id"), F.xxhash64(text).alias("d_key"))
    same = rows["d_id"].eqNullSafe(keep["k_id"]) & (rows["d_key"] == keep["k_key"])
    hit = rows.join(keep, same)
    # Repeated rows of one kept document: one stays.
    one = hit.where("not bare").dropDuplicates(["k_id", "k_key"])
    return one.select("row.*").unionByName(hit.where("bare").select("row.*"))


def op7_grouped_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_components(spark, read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
