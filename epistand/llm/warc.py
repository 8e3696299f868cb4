"""WARC archives written and read by Spark, and an external merge of their capture runs.

Writing: one WARC/1.1 record per page through Spark's text writer, whose line separator
``\\r\\n\\r\\n`` is the record terminator of the format, so files are committed by Spark's own
committer and survive lost executors. Reading: whole files (bounded by ``records_per_file``) are
parsed by Content-Length and every response's digest is verified. Index: each file yields a run of
captures sorted by (URL key, timestamp); runs are cut at common range bounds and every range is
merged k-way with a loser tree, so that partitions in order hold the global capture history.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistand.llm.common import shared_table

CRLF = "\r\n"
END = CRLF + CRLF
FIRST_SECOND = 1577836800  # capture time of key 0 where pages carry no time: 2020-01-01 UTC
SPAN = 3_155_760_000  # a hundred years of seconds: keys beyond start over, so that every date has four digits


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
               min_revisit_bytes: int = 100, records_per_file: int = 2000) -> None:
    """Write ``pages`` as gzip WARC files under ``path``.

    Of pages with equal payloads of at least ``min_revisit_bytes`` UTF-8 bytes the one with the
    smallest key is a response and the others are revisits of it (of repeated rows one is the
    response); shorter payloads are all responses. NULL html is an empty payload; a NULL url or key
    leaves out its header, and a NULL key is chosen last. The capture time is the key (modulo
    100 years) in seconds after 2020-01-01. Extra columns are ignored; an empty table writes no records."""
    body = F.coalesce(pages[html], F.lit(""))
    rows = pages.select(pages[key].cast("long").alias("id"), pages[url].cast("string").alias("url"), body.alias("body"))
    rows = rows.select("*", F.octet_length("body").alias("size"), F.sha2("body", 256).alias("sha"),
                       F.monotonically_increasing_id().alias("rid"))
    long = F.col("size") >= min_revisit_bytes
    first = (rows.where(long).select("sha", F.struct(F.isnull("id").alias("none"), "id", "rid").alias("best"))
             .groupBy("sha").agg(F.min("best").alias("best"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("sha", F.col("best.id").alias("first_id"), F.col("best.rid").alias("first_rid")))
    rows = rows.join(first, "sha", "left")
    again = long & F.col("first_rid").isNotNull() & (F.col("first_rid") != F.col("rid"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    some = lambda name, value: F.coalesce(line(name, value.cast("string")), F.lit(""))
    kind = F.when(again, "revisit").otherwise("response")
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    payload = F.when(again, "").otherwise(F.col("body"))
    length = F.octet_length(http) + F.when(again, 0).otherwise(F.col("size"))
    when = F.date_format(F.timestamp_seconds(F.lit(FIRST_SECOND) + F.coalesce(F.pmod("id", F.lit(SPAN)), F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws(":", "id", "rid", "sha"), 256), F.lit(">"))),
        line("WARC-Date", when), some("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "sha")),
        F.when(again, F.concat(line("WARC-Profile", F.lit(profile)), some("X-Refers-To-Page", F.col("first_id"))))
        .otherwise(""),
        some("X-Page-Id", F.col("id")), line("X-Payload-Length", F.col("size").cast("string")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", length.cast("string")), F.lit(CRLF), http, payload)
    (rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path))


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query, lower-cased; '' for NULL."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){tail}".lower()


_RECORD = ("run string, offset long, length long, record_type string, page_id long, url string, url_key string, "
           "ts string, payload_digest string, payload_bytes long, refers_to long")


def _parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in data[at:stop].decode().split(CRLF)[1:])
        body = stop + 4
        end = body + int(head["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"no record end at {end}")
        yield at, end + 4 - at, head, data[body:end]
        at = end + 4


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives under ``path``; one sorted run of captures per file.

    Responses are verified against their digest (a mismatch raises). ``with_payload`` adds the
    payload text (NULL for revisits)."""

    def parse(batches):
        number = lambda x: int(x) if x is not None else None
        for batch in batches:
            for run, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                raw = content.as_buffer()
                raw = zlib.decompress(raw, 31) if run.endswith(".gz") else raw.to_pybytes()
                rows = []
                for at, length, h, block in _parse(raw):
                    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest
                                               or len(payload) != int(h["X-Payload-Length"])):
                        raise ValueError(f"damaged record in {run} at {at}")
                    url = h.get("WARC-Target-URI")
                    rows.append((run, at, length, kind, number(h.get("X-Page-Id")), url, surt(url), h["WARC-Date"], digest,
                                 int(h["X-Payload-Length"]), number(h.get("X-Refers-To-Page")),
                                 *([payload.decode() if kind == "response" else None] if with_payload else [])))
                rows.sort(key=lambda r: (r[6], r[7], r[1]))
                for i in range(0, len(rows), 500):
                    columns = zip(*rows[i:i + 500], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = _RECORD + (", payload string" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64() if x.endswith("long") else pa.string() for x in schema.split(", ")]
    # one row a batch: memory holds one archive file at a time
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parse, schema)


def loser_tree_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted lists of tuples (key first) with a tree of losers; equal keys by run number.

    Each of the k leaves is a run's current entry; inner nodes keep the loser of their match, so
    the next winner costs one comparison per level."""
    runs = [r for r in runs if r]
    k = len(runs)
    if k == 0:
        return
    at = [0] * k
    done = (1,)
    entry = lambda i: (0, runs[i][at[i]], i) if at[i] < len(runs[i]) else (*done, (), i)
    losers: list = [None] * k
    winners: list = [None] * k + [entry(i) for i in range(k)]
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if a <= b else (b, a)
    best = winners[1] if k > 1 else entry(0)
    while best[0] == 0:
        yield best[1]
        i = best[2]
        at[i] += 1
        best = entry(i)
        node = (i + k) // 2
        while node:
            if losers[node] < best:
                best, losers[node] = losers[node], best
            node //= 2


def merge_captures(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Capture history of all runs: ``records`` with ``capture_part, capture_pos``.

    Ordered by (capture_part, capture_pos) the rows ascend by URL key, timestamp, then run and
    offset. Ranges are cut on the full key, so a URL with very many captures spreads over ranges.
    No rows give no rows."""
    n = partitions or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = records.columns
    key = [fields.index(c) for c in ("url_key", "ts", "run", "offset")]

    def merge(batches):
        runs: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs.setdefault(row[key[2]], []).append(([row[i] for i in key], row))
        for run in runs.values():  # the shuffle keeps a run's rows but not their order
            run.sort(key=lambda x: x[0])
        merged = enumerate(loser_tree_merge(list(runs.values())))
        while part := list(islice(merged, 5000)):
            columns = [*zip(*(row for _, (_, row) in part), strict=True), [pos for pos, _ in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             [*fields, "capture_pos"])

    types = [pa.int64() if f.dataType.simpleString() == "bigint" else pa.string() for f in records.schema.fields]
    types.append(pa.int64())
    cut = records.repartitionByRange(n, "url_key", "ts", "run", "offset")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields) + ", capture_pos bigint"
    return cut.mapInArrow(merge, schema).withColumn("capture_part", F.spark_partition_id())


def roundtrip(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write ``pages`` to archives under ``path``, read them back and merge the capture runs."""
    write_warc(pages, path, **options)
    records = shared_table(read_warc(pages.sparkSession, path), "captures")
    return merge_captures(records)

