"""WARC archives: write records, read them back by boundary-chain verification.

Writing is plain Spark text output: a record is one row, and the two line
ends that close a record are the writer's line separator.  Reading never
trusts the record magic: tasks look for it in every byte of an archive and
emit for each place the offset at which its record would end; pointer jumping
from the file start then keeps the places that a chain of records reaches, so
magic inside a payload is rejected.

Defined cases: null html is an empty payload; equal payloads (empty ones too)
are one response, the smallest page_id (null ids last), and revisits; a
repeated row with the response's own id is a response too; an empty table gives
no rows; other columns are ignored; a file that does not begin with the magic
gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from topicweave.llm.common import HOT_ROWS, join_counted, read_table, scratch_path, stage_table

MAGIC = b"WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payload bytes at most, and records a file: 128 MB, 512 MB, and one record.
TIERS = ((1 << 16, 2000), (1 << 22, 128), (None, 1))
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of SHA-1, from built-in functions: 20 bits (five
    hex digits) make four letters."""
    hexed = F.sha1(data)
    letters = []
    for at in range(1, 41, 5):
        bits = F.conv(F.substring(hexed, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.lit(ALPHABET).substr(place, F.lit(1)))
    return F.concat(*letters)


def record_roles(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", hot: int = HOT_ROWS,
    observed: Observation | None = None, tiers: Sequence[Column] = (),
) -> DataFrame:
    """``pages`` as (id, uri, payload, digest, shared, first_id); first_id is the
    smallest id of a group of equal payloads.

    Only groups of equal payloads take part in the join, as a written table
    whose size Spark knows: small, it is broadcast and no payload moves; a
    payload of more than ``hot`` pages is broadcast in any case.  ``observed``
    counts the rows of each of ``tiers`` on the way.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    own = F.concat(F.lit("urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    uri = F.coalesce(F.col(url_col), own) if url_col in pages.columns else own
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(uri, r"[\x00-\x20\x7F]", "%20").alias("uri"),  # a header is one line
        payload.alias("payload"),
        base32_sha1(payload.cast("binary")).alias("digest"),
    )
    seen = rows if observed is None else rows.observe(observed, *[F.count(F.when(tier, 1)).alias(f"tier{i}") for i, tier in enumerate(tiers)])
    groups = seen.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("best"), F.count("*").alias("n")
    )
    shared = stage_table(groups.where("n > 1").select("digest", F.col("best.id").alias("first_id"), "n"), "warc-groups")
    return join_counted(rows, shared, "digest", "n", "left", hot).select(
        "id", "uri", "payload", "digest", F.col("n").isNotNull().alias("shared"), "first_id"
    )


def record_text(rows: DataFrame, min_revisit_bytes: int = 0, written: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One text value per row: the WARC record without its closing line ends.

    Payloads of fewer bytes than ``min_revisit_bytes`` are always responses;
    ``written`` is the records' date.
    """
    n = F.octet_length("payload")
    revisit = F.col("shared") & (n >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit(HTTP_HEAD), n.cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    refers = F.concat(F.lit("\r\nWARC-Refers-To: "), urn("first_id"), F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}"))
    head = F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        urn("id"),
        F.lit(f"\r\nWARC-Date: {written}\r\nWARC-Target-URI: "),
        F.col("uri"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(revisit, refers).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", records_per_file: int = 2000, min_revisit_bytes: int = 0,
    tiers: Sequence[tuple[int | None, int]] = TIERS, written: str | None = None, url_col: str = "url", hot: int = HOT_ROWS,
) -> None:
    """Write one record per row to archives of at most ``records_per_file``.

    ``tiers`` are (payload bytes at most, records a file at most), the last one
    without a bound in bytes.  Each tier that has rows is a write of its own;
    which ones have is counted while the payloads' groups are made.
    """
    n, least, sizes = F.octet_length("payload"), -1, []
    for most, _ in tiers:
        sizes.append((n > least) & (n <= most) if most is not None else n > least)
        least = most
    seen = Observation("warc-tiers")
    rows = record_roles(pages, id_col, payload_col, url_col, hot, seen, sizes)
    written = written or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    held = [seen.get[f"tier{i}"] > 0 for i in range(len(tiers))]
    if not any(held):
        held[0] = True  # an archive folder without records
    for i, (_, records) in enumerate(tiers):
        if held[i]:
            (
                record_text(rows.where(sizes[i]), min_revisit_bytes, written)
                .write.mode("append")
                .option("lineSep", RECORD_END)
                .option("maxRecordsPerFile", min(records, records_per_file))
                .text(folder)
            )


SCAN_SCHEMA = (
    "file string, at long, next long, record_type string, page_id long, refers_to long,"
    " payload_bytes long, payload_digest string"
)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode("latin-1")] = value.strip().decode("latin-1")
    return out


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def candidates(file: str, data: bytes) -> Iterator[tuple]:
    """Every place of the magic, and where a record that began there would end."""
    view, at = memoryview(data), data.find(MAGIC)
    while at >= 0:
        head_end = data.find(b"\r\n\r\n", at)
        fields = _fields(data[at:head_end]) if head_end >= 0 else {}
        length = fields.get("content-length", "")
        if length.isdigit():
            block = head_end + 4
            end = block + int(length)
            if end + 4 <= len(data) and data[end : end + 4] == b"\r\n\r\n":
                http = data.find(b"\r\n\r\n", block, end)
                size, digest = None, None
                if http >= 0:
                    if fields.get("warc-type") == "revisit":
                        said = _fields(data[block:http]).get("content-length", "")
                        size, digest = (int(said) if said.isdigit() else None), fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    else:
                        size = end - http - 4
                        digest = base64.b32encode(hashlib.sha1(view[http + 4 : end]).digest()).decode()
                yield (file, at, end + 4, fields.get("warc-type"), _page(fields.get("warc-record-id")), _page(fields.get("warc-refers-to")), size, digest)
        at = data.find(MAGIC, at + 1)


def scan_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All candidate records of all archives, reachable or not."""
    names = [x.split()[0] for x in SCAN_SCHEMA.split(",")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def scan(batches):
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1), strict=True):
                columns = list(zip(*candidates(file.as_py(), data.as_py()), strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(scan, SCAN_SCHEMA)


def chained(links: DataFrame, start: int = 0) -> DataFrame:
    """Rows of ``links`` (file, at, next) that a chain from ``start`` reaches.

    Pointer jumping: each round doubles both the known chain and the jump
    length, so a chain of n records takes log2(n) rounds.  Offsets compress
    well on disk, so the joins ask for sorting: by file size Spark would take
    these tables for small ones and broadcast them.
    """
    longest = links.groupBy("file").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    jump = links.select("file", "at", "next")
    reached = jump.where(F.col("at") == start).select("file", "at")
    for step in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        ahead = reached.join(jump.hint("merge"), ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = stage_table(reached.unionByName(ahead.join(links.select("file", "at").hint("merge"), ["file", "at"], "left_semi")).distinct(), f"warc-reached-{step}")
        far = jump.select("file", F.col("at").alias("mid"), F.col("next").alias("far"))
        near = jump.select("file", "at", F.col("next").alias("mid"))
        jump = stage_table(near.join(far.hint("merge"), ["file", "mid"]).select("file", "at", F.col("far").alias("next")), f"warc-jump-{step}")
    return reached


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The archives' real records: page_id, payload_bytes, payload_digest,
    record_type, refers_to, file, at."""
    found = stage_table(scan_archives(spark, folder).withColumn("key", F.unhex(F.md5("file"))), "warc-candidates")
    real = chained(found.select(F.col("key").alias("file"), "at", "next"))
    return found.join(real.withColumnRenamed("file", "key").hint("merge"), ["key", "at"], "left_semi").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "at"
    )


def op9_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).drop("file", "at")


OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda i: substr('{ALPHABET}',
           (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
         first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS first_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""
