"""Language-model scores from a log-frequency Bloom filter.

Training counts words and word pairs of all training texts. The filter stores a count c as the
items (gram, 1) .. (gram, q) with q = 1 + floor(log c / log base); a scorer probes q = 1, 2, ...
until the first miss, and takes the middle of that count class. The filter is cut into chunks by
gram hash. Every word and every pair goes in: a chunk has as many bits as its items need to fill
it to ``load``, so the filter grows with the grams, and no task holds it as a whole.

Counting and probing are one shuffle. Texts are packed into blocks; a block sends its distinct
grams with their counts in training texts (0 in others), sorted and dealt by chunk. The task of a
range of chunks sums the counts, builds the bits, probes them for every block and returns one byte
(the level) a gram. Words go by 64-bit hashes, pairs by the leading 48 bits: with 10**9 pairs that
adds 4 in 10**6 false positives to the filter's own (``load`` ** 4, 6 % by default).

The model: P(w | h) = (c(hw) + strength * P(w)) / (c(h) + strength) with P(w) = (c(w) + a) / (N + a
(V + 1)), log10 summed over the words and the end of the text.

The exact unigram score needs exact counts. The most frequent words' counts (at most
``hot_words``) are broadcast; all other words of a text go through a join with the counts table.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import (
    _BASE, BLOCK_BYTES, LONG_ROWS, Shared, arrow_batches, mix64, ngram_hashes, release_memory, shared_table, text_blocks, word_hashes)

END, START = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0x5747A7745747A775)  # marks of a text's ends
CHUNKS = 4096
PROBES = 4
MAX_LEVEL = 200
PAIR_BITS = np.uint64(0xFFFFFFFFFFFF0000)
LOW = (0, 2)  # lowest bytes not sent of words and pairs
PIECE_BYTES = BLOCK_BYTES // 4  # text of a block that is hashed at a time
SENT_BYTES = 1 << 20  # after which a batch to a worker ends: the JVM holds each batch twice outside its heap


def token_arrays(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of START, words, END of all texts in a row; each one's text; is START."""
    words, before = word_hashes(data, offsets)
    n = np.diff(before)
    text = np.repeat(np.arange(len(n)), n + 2)
    last = np.cumsum(n + 2) - 1
    first = last - n - 1
    seq = np.zeros(len(text), np.uint64)
    inner = np.ones(len(text), bool)
    inner[first], inner[last] = False, False
    seq[inner], seq[first], seq[last] = words, START, END
    start = np.zeros(len(text), bool)
    start[first] = True
    return seq, text, start


def chunk_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(52)).astype(np.int64)  # 4096 chunks by the leading 12 bits


def pack(x: np.ndarray, low: int = 0) -> bytes:
    """Bytes of an array by significance, the ``low`` lowest left out: sorted hashes and small
    counts compress well so."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T[low:].tobytes()


def unpack(data, dtype: type, low: int = 0) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size - low, -1)
    out = np.zeros((planes.shape[1], size), np.uint8)
    out[:, low:] = planes.T
    return out.view(dtype).ravel()


class ChunkFilter:
    """The bits of some chunks; grams of other chunks are unseen."""

    def __init__(self, chunks: dict[int, bytes]):
        self.start, self.size = np.zeros(CHUNKS, np.int64), np.zeros(CHUNKS, np.int64)
        at = 0
        for c, data in chunks.items():
            self.start[c], self.size[c] = at * 8, len(data) * 8
            at += len(data)
        self.bits = np.frombuffer(b"".join(chunks.values()), np.uint8)

    def holds(self, h: np.ndarray, level: int) -> np.ndarray:
        """Numbers of the grams whose item (gram, level) the filter seems to hold."""
        chunk = chunk_of(h)
        left = np.flatnonzero(self.size[chunk])
        start, size = self.start[chunk], self.size[chunk]
        for i in range(PROBES):
            pos = start[left] + bit_position(h[left], level, i, size[left])
            left = left[((self.bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).astype(bool)]
        return left

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Level of each gram, found by probing level by level; 0 for unseen ones."""
        out, left, level = np.zeros(len(h), np.uint8), np.arange(len(h)), 1
        while len(left) and level < MAX_LEVEL:
            left = left[self.holds(h[left], level)]
            out[left] = level
            level += 1
        return out


@dataclass
class CountModel:
    base: float
    tokens: int
    types: int
    texts: int
    added: float
    strength: float

    def middles(self) -> np.ndarray:
        """Expected count by level: the middle of its class, 0 for level 0."""
        return np.array([0.0, *(sum(class_bounds(q, self.base)) / 2 for q in range(1, MAX_LEVEL))])

    def score(self, grams: BlockGrams, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Summed log10 probability of each text's words and end, from the levels of its grams."""
        middle = self.middles()
        single = middle[words][grams.word_at]
        single[grams.start] = self.texts
        unigram = (single + self.added) / (self.tokens + self.added * (self.types + 1))
        context = single[grams.own - 1]
        joint = np.minimum(middle[pairs][grams.pair_at], context)
        p = (joint + self.strength * unigram[grams.own]) / (context + self.strength)
        return np.bincount(grams.text[grams.own], weights=np.log10(np.minimum(p, 1.0)), minlength=grams.texts)


class BlockGrams:
    """Distinct words and pairs of a block of texts, and where its tokens have them."""

    def __init__(self, texts: pa.Array):
        parts, self.texts = [], 0
        for lo, hi, data, offsets in text_blocks(texts, PIECE_BYTES):
            seq, text, start = token_arrays(data, offsets)
            parts.append((seq, text + lo, start))
            self.texts = hi
        seq, self.text, self.start = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.own = np.flatnonzero(~self.start)
        self.words, self.word_at = np.unique(seq, return_inverse=True)
        pair = ngram_hashes(seq, 2)[self.own - 1] & PAIR_BITS
        self.pairs, self.pair_at = np.unique(pair, return_inverse=True)


def class_bounds(level: int, base: float) -> tuple[int, int]:
    """Smallest and largest count of a class (equal where the class is empty)."""
    low = int(np.ceil(base ** (level - 1) - 1e-9))
    return low, max(low, int(np.ceil(base ** level - 1e-9)) - 1)


def levels(count: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(base) + 1e-9).astype(np.int64)


def bit_position(h: np.ndarray, level, i: int, bits: int) -> np.ndarray:
    """Position within its chunk of the i-th bit of (gram, level)."""
    with np.errstate(over="ignore"):
        x = mix64(h + np.asarray(level).astype(np.uint64) * _BASE + np.uint64(i))
    return ((x >> np.uint64(32)).astype(np.int64) * bits) >> 32


def chunk_filter(h: np.ndarray, count: np.ndarray, base: float, load: float) -> bytes:
    """Bytes of one chunk: all grams, with the bits that make it ``load`` full (expected share set)."""
    n = levels(count, base)
    bits = 8 * int(np.ceil(n.sum() * PROBES / -np.log(1 - load) / 8))
    item = np.repeat(h, n)
    level = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n) + 1
    out = np.zeros(bits, np.uint8)
    for i in range(PROBES):
        out[bit_position(item, level, i, bits)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(n, first) if len(h) else n


def _dealt(h: np.ndarray, groups: int) -> list[tuple[int, int, int]]:
    """(group, first, end) of the slices of sorted hashes that go to each group of chunks."""
    group = chunk_of(h) * groups // CHUNKS
    cut = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(h)]])
    return [(int(group[a]), int(a), int(b)) for a, b in zip(cut, cut[1:], strict=False) if a < b]


def text_table(rows: DataFrame) -> DataFrame:
    """(bid, size, ids, train, texts): rows of a task packed into blocks of up to about 4 MB of text."""

    def blocks(batches):
        held, size, weight = [], 0, 0  # weight counts empty texts too

        def packed():
            n = sum(len(x) for x in held)
            one = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays([x[c] for x in held]))
                   for c in ("doc_id", "train", "text")]
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), *one], ["size", "ids", "train", "texts"])

        for batch in batches:
            for lo, hi, data, _ in text_blocks(batch["text"], PIECE_BYTES):
                more = len(data) + 16 * (hi - lo)
                if held and weight + more > 2 * BLOCK_BYTES:
                    yield packed()
                    held, size, weight = [], 0, 0
                held.append(batch.slice(lo, hi - lo))
                size, weight = size + len(data), weight + more
        if held:
            yield packed()

    with arrow_batches(rows.sparkSession, size=SENT_BYTES):
        packed = rows.mapInArrow(blocks, "size long, ids array<long>, train array<boolean>, texts array<string>")
        return shared_table(packed.withColumn("bid", F.monotonically_increasing_id()), "blocks", LONG_ROWS)


def count_and_probe(blocks: DataFrame, groups: int, base: float, load: float) -> DataFrame:
    """(kind, grp, bid, levels, h, n): kinds 0 and 1 the levels of a block's words and pairs that lie
    in group ``grp`` of the chunks, a byte each, and kind 2 a word's exact count."""

    def count(batches):
        for batch in batches:
            for i, bid in enumerate(batch["bid"].to_pylist()):
                grams = BlockGrams(batch["texts"].slice(i, 1).flatten())
                trains = batch["train"].slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(bool)[grams.text[grams.own]]
                n = (np.bincount(grams.word_at[grams.own[trains]], minlength=len(grams.words)),
                     np.bincount(grams.pair_at[trains], minlength=len(grams.pairs)))
                for kind, h in enumerate((grams.words, grams.pairs)):
                    dealt = _dealt(h, groups)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g for g, _, _ in dealt], pa.int32()), pa.array(np.full(len(dealt), kind, np.int32)),
                         pa.array(np.full(len(dealt), bid)), pa.array([pack(h[a:b], LOW[kind]) for _, a, b in dealt], pa.binary()),
                         pa.array([pack(n[kind][a:b].astype(np.uint32)) for _, a, b in dealt], pa.binary())],
                        ["grp", "kind", "bid", "h", "n"])
                del grams, trains, n, h
                release_memory()

    names = ["kind", "grp", "bid", "levels", "h", "n"]

    def answers(held, group, asked):
        level = held.levels(np.concatenate([h for _, _, h in asked]))
        cut = np.cumsum([len(h) for _, _, h in asked])[:-1]
        k = len(asked)
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _, _ in asked], pa.int32()), pa.array(np.full(k, group, np.int32)),
             pa.array([b for _, b, _ in asked], pa.int64()), pa.array([x.tobytes() for x in np.split(level, cut)], pa.binary()),
             pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)

    def merge(batches):
        # a partition is a group of chunks; what has arrived is summed whenever it has doubled, and
        # waits in a local file to be answered
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2  # words, pairs
        new, size, group = [[], []], 0, None

        def settle():
            for kind in (0, 1):
                h, n = zip(held[kind], *new[kind], strict=True)
                held[kind] = _summed(np.concatenate(h), np.concatenate(n))
                new[kind].clear()
            release_memory()

        with tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None) as waiting:
            for batch in batches:
                for g, kind, bid, h, n in zip(batch["grp"].to_pylist(), batch["kind"].to_pylist(), batch["bid"].to_pylist(),
                                              batch["h"], batch["n"], strict=True):
                    group = g
                    pickle.dump((kind, bid, h.as_py()), waiting)
                    h, n = unpack(h.as_buffer(), np.uint64, LOW[kind]), unpack(n.as_buffer(), np.uint32).astype(np.int64)
                    new[kind].append((h[n > 0], n[n > 0]))
                    size += len(new[kind][-1][0])
                    if size > max(1_000_000, len(held[0][0]) + len(held[1][0])):
                        settle()
                        size = 0
            settle()
            (h, n), (h2, n2) = held
            for lo in range(0, len(h), 100_000):
                part = h[lo:lo + 100_000].view(np.int64)
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, 2, np.int32)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                     pa.array(part), pa.array(n[lo:lo + 100_000])], names)
            of, of2 = chunk_of(h), chunk_of(h2)
            chunks = {}
            for c in np.union1d(of, of2):
                one, two = slice(*np.searchsorted(of, [c, c + 1])), slice(*np.searchsorted(of2, [c, c + 1]))
                chunks[c] = chunk_filter(np.concatenate([h[one], h2[two]]), np.concatenate([n[one], n2[two]]), base, load)
            held = [None, None]
            del h, n, h2, n2, of, of2
            release_memory()
            bits = ChunkFilter(chunks)
            chunks.clear()
            asked, size, end = [], 0, waiting.tell()
            waiting.seek(0)
            while waiting.tell() < end:
                kind, bid, data = pickle.load(waiting)
                asked.append((kind, bid, unpack(data, np.uint64, LOW[kind])))
                size += len(asked[-1][2])
                if size > 250_000:
                    yield answers(bits, group, asked)
                    asked, size = [], 0
            if asked:
                yield answers(bits, group, asked)
            del bits, asked
        release_memory()

    sent = blocks.select("bid", "train", "texts").mapInArrow(count, "grp int, kind int, bid long, h binary, n binary")
    return (sent.repartitionById(groups, F.col("grp"))
            .mapInArrow(merge, "kind int, grp int, bid long, levels binary, h long, n long"))


def score_texts(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", filter_bytes: int = 32 << 20,
                base: float = 1.5, load: float = 0.5, added: float = 0.1, strength: float = 5.0,
                hot_words: int = 500_000) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; the end of a text counts as one
    token. Rows where ``training`` is true train, all rows are scored; NULL and empty texts have the
    end as their only token. Repeated rows count and are scored each; a NULL key is kept; other
    columns are ignored. Without training texts counts are 0 and the score is that of a uniform
    model over one type; an empty table gives no rows. ``filter_bytes`` bounds the part of the filter
    that a task holds: there are at least as many tasks as parts of that size in the text, and a text
    brings at most an item a byte (up to the 4096 chunks that a filter is cut into)."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"),
                       F.coalesce(training, F.lit(False)).alias("train"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = text_table(rows)
    whole = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    groups = min(CHUNKS, max(n, -(-whole // filter_bytes)))
    with arrow_batches(spark, size=SENT_BYTES):
        found = shared_table(count_and_probe(blocks, groups, base, load), "grams", LONG_ROWS)
    words = found.where("kind = 2").select("h", "n")
    total = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    ends = words.where(F.col("h") == int(END.astype(np.int64))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    model = CountModel(base, int(total["n"]), int(total["v"]), int(ends), added, strength)
    hot = words.orderBy(F.desc("n"), "h").limit(hot_words).toArrow()  # 16 bytes each
    hot_h = hot["h"].to_numpy().view(np.uint64)
    order = np.argsort(hot_h)
    shared = Shared(spark, (model, hot_h[order], hot["n"].to_numpy()[order]))
    floor = float(np.log10(model.tokens + added * (model.types + 1)))

    def run(batches):
        m, known_h, known_n = shared.value
        log_n = np.log10(known_n + added)
        now, held = None, ([], [])

        def out():
            ids, train, texts = now
            grams = BlockGrams(texts)
            k, word, inverse, owner = grams.texts, grams.words, grams.word_at[grams.own], grams.text[grams.own]
            at = np.searchsorted(known_h, word)
            at[at == len(known_h)] = 0
            hit = known_h[at] == word if len(known_h) else np.zeros(len(word), bool)
            value = np.where(hit, log_n[at] if len(known_h) else 0.0, 0.0)
            found = hit[inverse]
            rare, per = word[inverse[~found]], np.bincount(owner[~found], minlength=k)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)),
                                             pa.array(rare.view(np.int64)))
            return pa.RecordBatch.from_arrays(
                [ids, train, pa.array(np.bincount(owner, minlength=k).astype(np.int64)),
                 pa.array(np.bincount(owner[found], minlength=k).astype(np.int64)),
                 pa.array(np.bincount(owner, weights=value[inverse], minlength=k)),
                 pa.array(m.score(grams, *(np.frombuffer(b"".join(x), np.uint8) for x in held))), lists],
                ["doc_id", "train", "n_tokens", "known", "logs", "score", "rare"])

        for batch in batches:
            for i, kind in enumerate(batch["kind"].to_pylist()):
                if kind < 0:
                    if now:
                        yield out()
                        release_memory()
                    now, held = [batch[c].slice(i, 1).flatten() for c in ("ids", "train", "texts")], ([], [])
                else:
                    held[kind].append(batch["levels"][i].as_py())
        if now:
            yield out()
        now = held = None
        release_memory()

    nothing = lambda c: F.lit(None).cast(blocks.schema[c].dataType).alias(c)
    replies = found.where("kind < 2").select("bid", "kind", "grp", *map(nothing, ("ids", "train", "texts")), "levels")
    joined = blocks.select("bid", F.lit(-1).alias("kind"), F.lit(0).alias("grp"), "ids", "train", "texts",
                           F.lit(None).cast("binary").alias("levels"))
    joined = joined.union(replies).repartition(n, "bid").sortWithinPartitions("bid", "kind", "grp")
    scored = joined.mapInArrow(run, "doc_id long, train boolean, n_tokens long, known long, logs double, score double, rare array<long>")
    with arrow_batches(spark, size=SENT_BYTES):
        scored = shared_table(scored.withColumn("rid", F.monotonically_increasing_id()), "scores")
    rare = scored.select("rid", F.explode("rare").alias("h")).join(words, "h", "left")
    rare = rare.groupBy("rid").agg(F.count("n").alias("rare_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + added)).alias("rare_logs"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (scored.drop("rare").join(rare, "rid", "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("known") + zero("rare_known")).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score"))
