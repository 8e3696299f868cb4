"""Helpers shared by the operators: shared-folder tables, text blocks, hashes, components."""

from __future__ import annotations

import ctypes
import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistand.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK_BYTES = 2 << 20  # text handled at a time in a worker; one longer text forms a block alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int | None = None, size: int | None = None) -> Iterator[None]:
    """Jobs run inside send at most ``rows`` rows, and no further row after ``size`` bytes, at a time to
    Python workers."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name, None) for name, x in names.items() if x is not None}
    for name in before:
        spark.conf.set(name, str(names[name]))
    try:
        yield
    finally:
        for name, x in before.items():
            spark.conf.unset(name) if x is None else spark.conf.set(name, x)


#: Parquet's writer asks after so many rows whether a page is full. By default it waits for 100 rows, which
#: makes pages of 100 times a long row, and buffers of that size outside the heap on both sides.
LONG_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "16"}


def shared_table(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the folder named by spark.checkpoint.dir and read it back.

    Cuts the lineage: a lost executor costs a re-read of shared files, not the upstream job."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``shared_table`` wrote for ``tables``, which nothing may read any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._shared_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class Shared:
    """A broadcast value whose classes are shipped with it: Spark pickles broadcast values by reference,
    and executors have no copy of this package. ``value`` is unpacked once a task."""

    def __init__(self, spark: SparkSession, value):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = pickle.loads(self._packed.value)
        return self._value

    def __getstate__(self):
        return {"_packed": self._packed}


def folded(text):
    """NULL as empty, A-Z (and nothing else) lower-cased."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def fold_of(key: str, mod: int):
    """crc32 of the key's decimal text, modulo ``mod``; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def release_memory() -> None:
    """Give freed memory back to the system: a worker process outlives its task, and what one stage
    leaves in it would be missing for the next. Does nothing where the C library can't."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, row offsets) of consecutive rows of about ``limit`` bytes.

    NULL rows have no bytes. Rows are never cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return
    off = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    release_memory()


# 64-bit odd multiplier of the polynomial word hash, and the constants of the SplitMix64 finaliser.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


class _Made(list):
    """Tables that a process makes for itself: shipped by value, the list is empty, so that what the
    driver has made does not travel with every function that uses it."""

    def __reduce__(self):
        return _Made, ()


_POWERS: list[np.ndarray] = _Made()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse modulo 2**64, from power 0 on."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = 1 << (max(BLOCK_BYTES // 2, n) - 1).bit_length()  # grows by doubling
        _POWERS.clear()
        for b in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            table = np.full(n, b, np.uint64)
            table[0] = 1
            with np.errstate(over="ignore"):
                _POWERS.append(np.cumprod(table, out=table))
    return _POWERS[0], _POWERS[1]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, in text order,
    and for each row the number of words before it (one entry more than rows)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * down[starts]
        h = mix64(h + (ends - starts).astype(np.uint64) * _M2)
    return h, np.searchsorted(starts, offsets).astype(np.int64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each position; the last n - 1 positions are left out."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = words[:count].copy()
        for i in range(1, n):
            h = mix64(h * _BASE + words[i:i + count])
    return h


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, component_id) of every node of ``edges`` (long ids): smallest id reachable.

    Alternating large-star and small-star rounds: each keeps at most as many links as before and
    every step is a keyed aggregate and join, so nothing is gathered. A round's links are written
    to the shared folder. Nodes without links are not returned; an empty input gives no rows."""
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    cur = shared_table(cur, "cc")

    def digest(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = digest(cur)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small-star: u's neighbours are all smaller here
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        before, cur = cur, shared_table(small, "cc")
        discard(before)
        now = digest(cur)
        if now == seen:
            return _labels(cur)
        seen = now
    if seen[0] == 0:
        return _labels(cur)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _labels(stars: DataFrame) -> DataFrame:
    """Star links (node, root) as (id, component_id), roots included."""
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        stars.select(F.col("v").alias("id"), F.col("v").alias("component_id"))).distinct()
