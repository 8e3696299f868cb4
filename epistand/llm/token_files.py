"""Token-id files: one concatenated id array with Elias-Fano coded document boundaries.

Texts are dealt over ranges of the document id, sorted, tokenised and written as segments. A
segment is one file: a fixed header, the ids of its documents as an array of 2 or 4 bytes each, the
document ends and the document ids. Both sequences ascend, so both are Elias-Fano coded: about
2 + log2(universe / n) bits an entry, the low bits packed, the high parts in unary, with the
position of every 512th one kept in 4 bytes so that an offset is selected without decoding the rest.
A segment holds at most ``SEGMENT_IDS`` ids (or one longer document), so no table of 8-byte offsets
is needed anywhere.

Spark's own writer commits the files (one record a file, its line separator ends the file), and
they are read back with ``binaryFile``, one segment at a time.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epistand.llm.common import shared_table, text_blocks

SEGMENT_IDS = 4_000_000  # ids of a file; a longer document has a file alone
SEGMENT_DOCS = 250_000
TEXT_BYTES = 4 << 20  # text encoded at a time: its distinct pieces are looked up once
RANGE_BYTES = 32 << 20  # text dealt to one range
MAX_RANGES = 20_000  # beyond, ranges grow; a range is streamed segment by segment
SAMPLE = 512  # ones of the high bits between two kept positions
FAN = 1000  # ranges summed in one task

_HEAD = "<4sHHIIQQQqQQ"  # magic, version, id bytes, range, segment, documents, ids, null ids, least id, two sizes
_MAGIC = b"TIDS"
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of ``n`` integers in ``[0, last]``; ``bytes(...)`` is its code."""

    _SHAPE = "<QQB"

    def __init__(self, code):
        self.n, high, self.low_bits = struct.unpack_from(self._SHAPE, code)
        at = struct.calcsize(self._SHAPE)
        low = (self.n * self.low_bits + 7) // 8
        self._low = np.frombuffer(code, np.uint8, low, at)
        self._high = np.frombuffer(code, np.uint8, (high + 7) // 8, at + low)
        self._samples = np.frombuffer(code, "<u4", -(-self.n // SAMPLE), at + low + len(self._high))
        self.size = at + low + len(self._high) + 4 * len(self._samples)

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        """Code of non-negative integers in non-decreasing order."""
        v = np.asarray(values).astype(np.uint64)
        n = len(v)
        if n == 0:
            return struct.pack(cls._SHAPE, 0, 0, 0)
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.concatenate([((v[i:i + 65536, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
                              for i in range(0, n, 65536)])
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return (struct.pack(cls._SHAPE, n, len(high), low_bits) + np.packbits(low, bitorder="little").tobytes()
                + np.packbits(high, bitorder="little").tobytes() + ones[::SAMPLE].astype("<u4").tobytes())

    def _join(self, i: np.ndarray, ones: np.ndarray) -> np.ndarray:
        out = (ones - i).astype(np.uint64) << np.uint64(self.low_bits)
        at = i * self.low_bits
        for b in range(self.low_bits):
            bit = (self._low[(at + b) >> 3] >> ((at + b) & 7).astype(np.uint8)) & 1
            out |= bit.astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """Entry ``i``: from the kept position before it, one stretch of high bits is counted."""
        at, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at >> 3, at & 7
        left += int(_POP[self._high[byte] & ((1 << skip) - 1)])
        step = 256
        while True:
            ahead = np.cumsum(_POP[self._high[byte:byte + step]])
            if ahead[-1] > left:
                k = int(np.searchsorted(ahead, left, side="right"))
                left -= int(ahead[k - 1]) if k else 0
                bits = np.flatnonzero(np.unpackbits(self._high[byte + k:byte + k + 1], bitorder="little"))
                one = (byte + k) * 8 + int(bits[left])
                return int(self._join(np.array([i]), np.array([one]))[0])
            left -= int(ahead[-1])
            byte += len(ahead)

    def select_many(self, lo: int, hi: int) -> np.ndarray:
        """Entries lo..hi-1, reading only the high bits from the kept position before ``lo``."""
        if hi <= lo:
            return np.zeros(0, np.uint64)
        first = lo // SAMPLE
        start = int(self._samples[first])
        after = -(-hi // SAMPLE)
        stop = int(self._samples[after]) if after < len(self._samples) else len(self._high) * 8
        byte = start >> 3
        bits = np.unpackbits(self._high[byte:(stop + 7) // 8 + 1], bitorder="little")
        bits[:start & 7] = 0
        ones = np.flatnonzero(bits)[lo - first * SAMPLE:hi - first * SAMPLE] + byte * 8
        return self._join(np.arange(lo, hi), ones)

    def find(self, value: int) -> int:
        """Number of entries below ``value``, by selects."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            if self.select(mid) < value:
                lo = mid + 1
            else:
                hi = mid
        return lo


class Segment:
    """One file: ids, document ends and document ids (null ids first, then ascending)."""

    def __init__(self, data):
        magic, version, width, self.part, self.seq, self.docs, self.ids_total, self.nulls, self.least, a, b = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token file")
        at = struct.calcsize(_HEAD)
        self.ids = np.frombuffer(data, f"<u{width}", self.ids_total, at)
        at += width * self.ids_total
        self.ends = EliasFano(memoryview(data)[at:at + a])
        self.keys = EliasFano(memoryview(data)[at + a:at + a + b])

    @staticmethod
    def encode(part: int, seq: int, ids: np.ndarray, counts: np.ndarray, nulls: int, keys: np.ndarray) -> bytes:
        ends = EliasFano.encode(np.cumsum(counts))
        least = int(keys[0]) if len(keys) else 0
        with np.errstate(over="ignore"):
            coded = EliasFano.encode(keys.astype(np.int64).view(np.uint64) - np.uint64(least % (1 << 64)))
        head = struct.pack(_HEAD, _MAGIC, 1, ids.dtype.itemsize, part, seq, len(counts), len(ids), nulls, least, len(ends), len(coded))
        return head + ids.astype(ids.dtype.newbyteorder("<")).tobytes() + ends + coded

    def span(self, i: int) -> tuple[int, int]:
        """First and end position of document ``i`` in the id array."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def key(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.keys.select(i - self.nulls)

    def find(self, key: int) -> int | None:
        """Number of the first document with this id, or None."""
        i = self.nulls + self.keys.find(key - self.least) if key >= self.least else self.docs
        return i if i < self.docs and self.key(i) == key else None


class PieceTokenizer:
    """Encodes blocks of texts with a byte-level ``tokenizers`` file, each distinct piece once.

    A text may be cut before a space that follows a character other than white space: no
    pre-token of a byte-level tokenizer spans such a place, so the pieces' ids, joined, are the
    text's. Pieces already met are taken from a cache, which is emptied at ``max_pieces``."""

    CHUNK = 1 << 16

    def __init__(self, path: str, max_pieces: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for word, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.bytes_of[i] = len(word)  # one character a byte
        for i, word in self.tok.get_added_tokens_decoder().items():
            self.bytes_of[i] = len(word.content.encode())
        self.dtype = np.dtype("u2" if len(self.bytes_of) <= 1 << 16 else "u4")
        self.max_pieces = max_pieces
        self._clear()

    def _clear(self):
        self.known: dict[bytes, int] = {}
        self.store = np.zeros(1 << 16, self.dtype)
        self.first = np.zeros(1 << 12, np.int64)  # of piece k: first id in the store; entry k + 1 ends it
        self.pieces = 0

    @staticmethod
    def solid(data: np.ndarray) -> np.ndarray:
        """Where a byte surely ends a character other than white space."""
        n = len(data)
        out = (data > 0x20) & (data < 0x7F)
        tail = (data & 0xC0) == 0x80
        for back, low, high in ((1, 0xC3, 0xDF), (2, 0xE4, 0xEF), (3, 0xF0, 0xF7)):
            # white space beyond ASCII begins with C2, E1, E2 or E3; those characters are not cut after
            out[back:] |= tail[back:] & (data[:n - back] >= low) & (data[:n - back] <= high)
        return out

    @classmethod
    def cuts(cls, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces: rows' starts and spaces after a character that is no white space."""
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = cls.solid(data)[:-1] & (data[1:] == 0x20)
        cut[offsets] = True
        return np.flatnonzero(cut[:-1])

    def _learn(self, new: list[bytes]) -> None:
        """Encode pieces, joined where the next one begins after a place where texts may be cut."""
        raw = b"".join(new)
        data = np.frombuffer(raw, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        starts = np.concatenate([[0], ends[:-1]])
        apart = np.ones(len(new), bool)
        apart[1:] = (data[starts[1:]] != 0x20) | ~self.solid(data)[ends[:-1] - 1] | (np.diff(starts // self.CHUNK) > 0)
        bounds = [*starts[apart].tolist(), len(raw)]
        ids = []
        for lo in range(0, len(bounds) - 1, 64):
            texts = [raw[a:b].decode() for a, b in zip(bounds[lo:lo + 64], bounds[lo + 1:lo + 65], strict=False)]
            for coded in self.tok.encode_batch_fast(texts, add_special_tokens=False):
                ids += coded.ids
        ids = np.array(ids, np.int64)
        covered = np.cumsum(self.bytes_of[ids])
        at = np.searchsorted(covered, ends)
        if at[-1] != len(ids) - 1 or not np.array_equal(covered[at], ends):
            raise ValueError("ids do not cover the text: the tokenizer is not byte-level")
        total = int(self.first[self.pieces])
        while total + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while self.pieces + len(new) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.store[total:total + len(ids)] = ids
        self.first[self.pieces + 1:self.pieces + len(new) + 1] = total + at + 1
        self.known.update(zip(new, range(self.pieces, self.pieces + len(new)), strict=True))
        self.pieces += len(new)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows one after the other, each followed by ``end_id``, and the ids per row."""
        rows = len(offsets) - 1
        if self.pieces > self.max_pieces:
            self._clear()
        starts = self.cuts(data, offsets) if len(data) else np.zeros(0, np.int64)
        bounds = np.append(starts, len(data)).astype(np.int64)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        piece = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(piece < 0)
        if len(new):
            piece[new] = np.arange(self.pieces, self.pieces + len(new))
            self._learn([distinct[i] for i in new.tolist()])
        piece = piece[coded.indices.to_numpy(zero_copy_only=False)] if distinct else starts
        lens = self.first[piece + 1] - self.first[piece]
        row_ends = np.searchsorted(starts, offsets[1:])
        before = np.concatenate([[0], np.cumsum(lens)])
        counts = np.diff(np.concatenate([[0], before[row_ends]])) + 1
        source = np.repeat(self.first[piece] - before[:-1], lens) + np.arange(before[-1])
        out = np.full(int(before[-1]) + rows, end_id, self.dtype)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(counts) - 1] = False
        out[keep] = self.store[source]
        return out, counts


def write_token_files(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> int:
    """Write the ids of every text, ``end_id`` after each, under ``path``; returns the number of ranges.

    Rows are ordered by the key (integers; null first), then by the text's 64-bit hash; equal rows in
    any order. Ranges are cut on this order and the row number, so a key that holds a third of all
    rows spreads over ranges. A null text is empty and has the end id alone. Extra columns are not
    read; an empty table writes no segment. ``tokenizer`` is the file of a byte-level tokenizer of
    the ``tokenizers`` library, on every executor."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    ranges = min(MAX_RANGES, max(1, -(-int(size) // RANGE_BYTES)))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("rid"))
    cut = rows.repartitionByRange(ranges, F.asc_nulls_first("key"), "h", "rid")
    cut = cut.sortWithinPartitions(F.asc_nulls_first("key"), "h", "text", "rid").select("key", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceTokenizer(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        ids, counts, keys, nulls, held = [], [], [], 0, 0

        def flush():
            blob = Segment.encode(part, seq, np.concatenate(ids), np.concatenate(counts), nulls, np.concatenate(keys))
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["segment"])

        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1), TEXT_BYTES):
                got, n = coder.encode(data, offsets, end_id)
                if counts and (held + len(got) > SEGMENT_IDS or sum(map(len, counts)) + len(n) > SEGMENT_DOCS):
                    yield flush()
                    seq, ids, counts, keys, nulls, held = seq + 1, [], [], [], 0, 0
                column = batch.column(0).slice(lo, hi - lo)
                nulls += column.null_count
                keys.append(column.drop_null().to_numpy())
                ids.append(got)
                counts.append(n)
                held += len(got)
        if counts:
            yield flush()

    (cut.mapInArrow(segments, "segment binary").select(F.col("segment").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))
    return ranges


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under ``path``: doc_id, part, seq (its file), doc_no, local
    start, n_tokens and ids_crc32 (crc32 of its ids as little-endian unsigned 32-bit integers)."""

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                raw = content.as_buffer()
                if raw.size < struct.calcsize(_HEAD):  # the file of a range without rows
                    continue
                s = Segment(raw)
                for lo in range(0, s.docs, 10000):
                    hi = min(lo + 10000, s.docs)
                    ends = s.ends.select_many(lo, hi).astype(np.int64)
                    starts = np.concatenate([[s.ends.select(lo - 1) if lo else 0], ends[:-1]]).astype(np.int64)
                    some = max(lo, s.nulls)
                    with np.errstate(over="ignore"):
                        known = (s.keys.select_many(some - s.nulls, max(hi, some) - s.nulls)
                                 + np.uint64(s.least % (1 << 64))).view(np.int64)
                    empty = pa.nulls(hi - lo - len(known), pa.int64())
                    crc = [zlib.crc32(s.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([empty, pa.array(known, pa.int64())]), pa.array(np.full(hi - lo, s.part, np.int64)),
                         pa.array(np.full(hi - lo, s.seq, np.int64)), pa.array(np.arange(lo, hi, dtype=np.int64)),
                         pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())],
                        ["doc_id", "part", "seq", "doc_no", "local", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(
        parse, "doc_id long, part long, seq long, doc_no long, local long, n_tokens long, ids_crc32 long")


def _before(parts: DataFrame, n: int) -> DataFrame:
    """(part, before) of ``parts`` (part in 0..n-1, total): the sum of the totals of smaller parts,
    ``FAN`` of them to a task, then their sums likewise."""
    group = (F.col("part") / FAN).cast("long")
    w = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = parts.select("part", "total", group.alias("group")).select(
        "part", "group", F.coalesce(F.sum("total").over(w), F.lit(0)).alias("before"))
    if n <= FAN:
        return inner.select("part", "before")
    outer = _before(parts.groupBy(group.alias("part")).agg(F.sum("total").alias("total")), -(-n // FAN))
    return inner.join(outer.select(F.col("part").alias("group"), F.col("before").alias("outer")), "group").select(
        "part", (F.col("before") + F.col("outer")).alias("before"))


def global_starts(rows: DataFrame, ranges: int) -> DataFrame:
    """``read_token_files`` rows with ``start``: the ids of all documents before each one."""
    segments = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("total"))
    parts = segments.groupBy("part").agg(F.sum("total").alias("total"))
    w = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = segments.select("part", "seq", F.coalesce(F.sum("total").over(w), F.lit(0)).alias("inside")).join(
        _before(parts, ranges), "part").select("part", "seq", (F.col("inside") + F.col("before")).alias("base"))
    return rows.join(base, ["part", "seq"]).withColumn("start", F.col("base") + F.col("local")).drop("base")


def roundtrip(docs: DataFrame, path: str, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` as token files under ``path`` and read every document's place, length and
    checksum back: doc_id, start, n_tokens, ids_crc32, and part, seq, doc_no (its file and number there)."""
    ranges = write_token_files(docs, path, tokenizer, **options)
    rows = shared_table(read_token_files(docs.sparkSession, path), "token-rows")
    return global_starts(rows, ranges).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "seq", "doc_no")
