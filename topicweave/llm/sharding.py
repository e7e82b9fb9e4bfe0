"""Sharding by a permutation-filled lookup table (Maglev hashing).

Each shard has its own order of preference over the slots of a prime-sized
table; shards take turns (a shard of weight w takes w turns a round) claiming
their next free slot until the table is full.  The table's size is a
parameter, so it is broadcast; a row's slot is its key's hash modulo the size,
so placement takes constant time and no shuffle.  When a shard comes or goes,
few other slots change hands.  Writing shuffles rows once, by shard and a salt.

Defined cases: a null key is placed like the empty string; equal keys share a
shard; an empty table gives no rows; other columns are kept by
``assign_shards`` (a clashing column gets the new one's place under a fresh
name) and dropped by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import fresh_name, read_table, scratch_path

SLOTS = 65537  # prime
SHARDS = 64
ROWS_PER_FILE = 1_000_000
BYTES_PER_FILE = 128 << 20  # of text, before compression


def _draw(name: str, salt: str, modulus: int) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big") % modulus


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> np.ndarray:
    """The shard number of each slot.

    Preference list of a shard: (offset + j * skip) mod slots for j = 0, 1, ...
    """
    if not is_prime(slots) or not shards or len(shards) > slots:
        raise ValueError("needs a prime number of slots, and from one to that many shards")
    weights = list(weights or [1] * len(shards))
    if len(weights) != len(shards) or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("needs a weight of at least 0 for each shard, one of them above 0")
    offset = [_draw(s, "offset", slots) for s in shards]
    skip = [_draw(s, "skip", slots - 1) + 1 for s in shards]
    table, tried, left = np.full(slots, -1, np.int32), [0] * len(shards), slots
    while left:
        for s, turns in enumerate(weights):
            for _ in range(turns):
                if not left:
                    return table
                while table[slot := (offset[s] + tried[s] * skip[s]) % slots] >= 0:
                    tried[s] += 1
                table[slot] = s
                tried[s] += 1
                left -= 1
    return table


def slot_of(key: Column, slots: int) -> Column:
    """A key's slot: the first 60 bits of the MD5 of its text, modulo the size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots).cast("long"))


def table_frame(spark: SparkSession, table: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, int(s)) for i, s in enumerate(table)], "slot long, shard int")


def assign_shards(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (names made free where they clash)."""
    slot, shard = fresh_name(df, "slot"), fresh_name(df, "shard")
    table = table_frame(df.sparkSession, lookup_table(shards, slots, weights))
    table = table.select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    # The table has exactly `slots` rows, whatever the data's size.
    return df.withColumn(slot, slot_of(F.col(key), slots)).join(F.broadcast(table), slot, "left")


def write_shards(
    df: DataFrame, key: str, shards: Sequence[str], folder: str, files_per_shard: int | None = None, slots: int = SLOTS, rows_per_file: int = ROWS_PER_FILE,
    bytes_per_file: int = BYTES_PER_FILE,
) -> str:
    """Place every row: one folder per shard, as many files as its rows and
    their text need (``files_per_shard`` fixes the number instead); returns the
    shard column.

    A shard's rows are dealt out to its files by a row number, not by the key,
    so a key that most rows have fills many files of its shard.  The counts that
    reach the driver are one a shard.
    """
    placed = assign_shards(df, key, shards, slots)
    name = next(c for c in reversed(placed.columns) if c.lower().startswith("shard"))
    if files_per_shard is None:
        text = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, kind in df.dtypes if kind in ("string", "binary")]
        sized = df.select(F.col(key).alias("key"), reduce(add, text, F.lit(0).cast("long")).alias("size"))
        counts = assign_shards(sized, "key", shards, slots).groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
        files = {r["shard"]: max(1, -(-r["n"] // rows_per_file), -(-r["size"] // bytes_per_file)) for r in counts}
    else:
        files = dict.fromkeys(range(len(shards)), files_per_shard)
    salt, number = fresh_name(placed, "file_salt"), fresh_name(placed, "row_number")
    of_shard = F.element_at(F.array(*[F.lit(files.get(s, 1)) for s in range(len(shards))]), F.col(name) + 1)
    # the scan's own numbering: the same again when a lost task is repeated
    numbered = placed.withColumn(number, F.monotonically_increasing_id())
    dealt = numbered.withColumn(salt, F.pmod(F.xxhash64(number), of_shard)).drop(number)
    tasks = max(1, sum(files.values()))
    dealt.repartition(tasks, F.col(name), F.col(salt)).drop(salt).write.option("compression", "zstd").partitionBy(name).parquet(folder)
    return name


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def op6_table_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents placed into their shards' files, and what is found there:
    doc_id, slot, shard, the file in the shard's folder and its text's CRC-32."""
    folder = scratch_path(spark, "shards")
    docs = read_table(spark, sf_dir, "documents")
    shard = write_shards(docs, "doc_id", shard_names(), folder)
    back = spark.read.parquet(folder)
    slot = next(c for c in reversed(back.columns) if c.lower().startswith("slot"))
    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return back.select("doc_id", F.col(slot).alias("slot"), F.col(shard).alias("shard"), file.alias("file"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
