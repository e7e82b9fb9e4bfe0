"""Best-two-fit packing of token sequences into fixed-size training sequences.

Texts are tokenised in the map tasks; what the packing itself needs is only
how many pieces there are of each length, a table as long as the capacity.
From it the driver plans whole patterns at a time: a bin is filled greedily
with the longest piece that fits; then its smallest piece is replaced by the
two unpacked pieces that fill the widened gap most; the pattern repeats for as
long as the same choices stay open.  Pieces get their rank within their length
(by hashed buckets, so a frequent length is spread) and look their place up.

Defined cases: null text is empty and becomes one piece that holds the end id;
a document longer than the capacity is cut into full pieces, the first piece
holding what is left over; repeated rows are packed each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from topicweave.llm.common import read_table, stage_table

CAPACITY = 2048
END_ID = 0
RANK_BUCKETS = 1024  # at least; more where a bucket would hold over RANK_ROWS pieces
RANK_ROWS = 10_000
VOCABULARY = "byte_bpe_50k.json"


def read_vocabulary(path: str | None = None) -> tuple[str, str]:
    """A byte-level BPE tokenizer file, and the pattern that splits its texts."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return f.read(), public_tokenizers.PATTERN


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level BPE files: printable
    Latin-1 stands for itself, the other bytes for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts.

    The ids are those of the tokenizer file, an added token in a text being its
    one id.  ``tiktoken`` computes them from the file's ranks several times as
    fast; texts that its splitter gives up on (very long runs of white space)
    go to ``tokenizers``.
    """

    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken

        said = json.loads(vocabulary)
        letters, special = byte_letters(), {t["content"]: t["id"] for t in said.get("added_tokens", ())}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in said["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.vocabulary, self.slow = vocabulary, None

    def __call__(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), np.uint32)
        except ValueError:
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.vocabulary)
            return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first is shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenise(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None, as_bytes: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids.

    ``as_bytes`` gives ``ids`` as the little-endian 32-bit numbers that
    ``ids_crc32`` is taken of, in place of an array.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = PIECE_SCHEMA + (", ids binary" if as_bytes else ", ids array<int>")

    def encode(batches):
        encoder = Encoder(*shared.value)
        for batch in batches:
            rows = {k: [] for k in ("doc_id", "piece", "start", "length", "crc")}
            ids_out = []

            def flush():
                cols = [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32())]
                cols += [pa.array(rows[k], pa.int64()) for k in ("start", "length", "crc")]
                if as_bytes:
                    cols.append(pa.array([x.tobytes() for x in ids_out], pa.binary()))
                else:
                    flat = np.concatenate(ids_out).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(rows["length"])]).astype(np.int32), pa.array(flat, pa.int32())))
                out = pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
                for v in rows.values():
                    v.clear()
                ids_out.clear()
                return out

            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for k, (a, m) in enumerate(piece_bounds(len(ids), capacity)):
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(k)
                    rows["start"].append(a)
                    rows["length"].append(m)
                    rows["crc"].append(zlib.crc32(ids[a : a + m].tobytes()))
                    ids_out.append(ids[a : a + m])
                held += len(ids)
                if held > 1 << 20:
                    yield flush()
                    held = 0
            if rows["doc_id"]:
                yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(encode, schema)


def _largest(lengths: np.ndarray, most: int) -> int:
    k = int(np.searchsorted(lengths, most, "right")) - 1
    return int(lengths[k]) if k >= 0 else 0


def plan(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Places for ``counts[length]`` pieces of each length, and the number of bins.

    A place row is (length, first rank, end rank, copies a bin, first bin,
    offset): piece ``rank`` of ``length`` lies in bin ``first bin + (rank -
    first rank) // copies``.
    """
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    places: list[tuple[int, ...]] = []
    bins = 0
    while left.any():
        lengths = np.flatnonzero(left)
        taken: dict[int, int] = {}
        gap, top = capacity, capacity
        while gap and (x := _largest(lengths, min(gap, top))):
            taken[x] = min(int(left[x]), gap // x)
            gap -= x * taken[x]
            top = x - 1
        need = dict(taken)
        smallest = min(taken)
        if gap:
            room = gap + smallest
            free = left.copy()
            for x, m in taken.items():
                free[x] -= m
            ls = np.flatnonzero(free[: room + 1])
            if len(ls):
                k = np.searchsorted(ls, np.minimum(room - ls, ls), "right") - 1
                alone = (k >= 0) & (ls[k] == ls) & (free[ls] < 2)
                k = k - alone
                total = np.where(k >= 0, ls + ls[k], 0)
                best = len(ls) - 1 - int(np.argmax(total[::-1]))  # of equal fits, the longer first piece
                if total[best] > smallest:
                    taken[smallest] -= 1
                    for x in (int(ls[best]), int(ls[k[best]])):
                        taken[x] = taken.get(x, 0) + 1
                        need[x] = need.get(x, 0) + 1
        taken = {x: m for x, m in taken.items() if m}
        times = min((int(left[x]) - need.get(x, 0)) // m + 1 for x, m in taken.items())
        offset = 0
        for x, m in sorted(taken.items(), reverse=True):
            places.append((x, int(used[x]), int(used[x]) + m * times, m, bins, offset))
            used[x] += m * times
            left[x] -= m * times
            offset += x * m
        bins += times
    return np.array(sorted(places), np.int64).reshape(-1, 6), bins


def ranked(pieces: DataFrame, buckets: int = RANK_BUCKETS) -> DataFrame:
    """``pieces`` with ``rank``, 0, 1, ... within each length."""
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        rows.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("begin") + F.col("at"))
        .drop("bucket", "at", "begin")
    )


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table) with ``sequence_id`` and ``offset``.

    What comes to the driver is one count per length, ``capacity`` at most.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    places, _ = plan(counts, capacity)
    # A row per length of each pattern; rows are joined in the JVM, so that the
    # pieces' ids pass through no Python step again.
    kinds = "p_length long, first_rank long, end_rank long, copies long, first_bin long, first_offset long"
    known = pieces.sparkSession.createDataFrame(places.tolist(), kinds)
    rows = ranked(pieces, max(RANK_BUCKETS, -(-int(counts.sum()) // RANK_ROWS)))
    here = (rows["length"] == known["p_length"]) & (rows["rank"] >= known["first_rank"]) & (rows["rank"] < known["end_rank"])
    return rows.join(F.broadcast(known), here).select(
        *pieces.columns,
        F.expr("first_bin + (rank - first_rank) div copies").alias("sequence_id"),
        F.expr("first_offset + (rank - first_rank) % copies * length").alias("offset"),
    )


def pack_documents(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None, as_bytes: bool = False) -> DataFrame:
    """Tokenise and pack: the pieces' columns, sequence_id and offset."""
    return place(stage_table(tokenise(docs, capacity, end_id, vocabulary, as_bytes), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences: sequence_id, ids (pieces in order, so at most
    ``capacity`` ids a row), n_pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.col("parts.ids"))
    if packed.schema["ids"].dataType == BinaryType():
        ids = F.aggregate("parts.ids", F.lit(b""), lambda done, part: F.concat(done, part))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", ids.alias("ids"), F.size("parts").alias("n_pieces"))


PACKED_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]


def packed_pieces(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The pieces of the training sequences with their ids, and where each lies."""
    return pack_documents(spark, docs, as_bytes=True).select(*PACKED_COLUMNS)


def op8_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(spark, read_table(spark, sf_dir, "documents"))
