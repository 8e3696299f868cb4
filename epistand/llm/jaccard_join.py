"""Exact Jaccard join of word n-gram sets by set-relation skipping.

Documents with equal sets are one class from the start. Sets are compared in one global order of
their n-grams (common ones last, then by hash); two sets can only link if their prefixes of length
n - ceil(t n) + 1 share an n-gram, so the index lists hold prefix n-grams with position and size.

* Index skipping: a list is cut into blocks by set size, postings with no other in their own or a
  neighbouring block are dropped before any shuffle of postings, and a pair is skipped when sizes, positions, parity sketches, or the
  n-grams missing within the common part of both prefixes leave too little for the threshold.
* Answer skipping: first every block compares its members with one leader only (linear in the
  postings). A member linked with the leader has the leader's answers: members of one component
  are never compared. One leader is the block's most central member; in long blocks members that
  just fail to link with it are compared too, so that a group of near copies has one leader. Then
  members outside a list's main component are tried against another of its members, and at last
  all pairs that are still open are decided; in both steps the overlap follows from the sets'
  differences to their common leader where these are known, without touching the sets. Two sets
  with the same leader don't meet in the lists: where they can link, enough of their differences
  are the same ones, and they meet there. So a group of near copies costs a few comparisons per member.

All remaining pairs of different components that pass the filters are decided exactly, so no link
between components is missed and none below the threshold is made.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epistand.llm.common import BLOCK_BYTES, connected_components, discard, mix64, ngram_hashes, shared_table, text_blocks, word_hashes

_CHUNK_BITS = 16  # a bit set is dealt in chunks of 8 KB
_PARTS = 8  # leading bits of a cell's position that deal the counting
HASH_BITS = 60  # of an n-gram; its frequency class stands above them
SKETCH_WORDS = 4  # 64-bit words of a set's parity sketch
MINHASHES = 4
LEADERS = 2  # of each block, besides its most central member: those that come first in as many fixed random orders
HUB = 8  # postings of a block from which members that just fail to link with the central one are compared with it
STRIP = 3  # neighbouring blocks dealt together where all open pairs are met
_SALT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(column: pa.Array, n: int):
    """For blocks of rows: (first row, end row, n-gram hashes of the rows' sets, set sizes).

    A row's hashes are distinct and ascending, HASH_BITS bits each. A text with fewer than n words has its
    whole word sequence as one; without words the set is empty."""
    for lo, hi, data, offsets in text_blocks(column, BLOCK_BYTES // 2):
        words, before = word_hashes(data, offsets)
        count = np.diff(before)
        gram = ngram_hashes(words, n)
        row = np.repeat(np.arange(hi - lo), count)
        left = before[1:][row] - np.arange(len(words))  # words from here to the row's end
        whole = left >= n
        g, r = gram[whole[:len(gram)]], row[:len(gram)][whole[:len(gram)]]
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            seq = np.full(len(short), _SALT) + count[short].astype(np.uint64)
            for i in range(n - 1):
                more = count[short] > i
                seq[more] = mix64(seq[more] * _SALT + words[before[:-1][short[more]] + i])
            g, r = np.concatenate([g, seq]), np.concatenate([r, short])
        g = g >> np.uint64(64 - HASH_BITS)
        order = np.lexsort((g, r))
        g, r = g[order], r[order]
        keep = np.ones(len(g), bool)
        keep[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
        g, r = g[keep], r[keep]
        yield lo, hi, g, np.bincount(r, minlength=hi - lo).astype(np.int64)


def prefix_lengths(size: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.where(size > 0, size + (-num * size // den) + 1, 0)


def bit_set(values: DataFrame, column: str, bits: int):
    """Bit set of a column of hashes: 2**bits bits (a fixed size), by leading bits.

    Membership tests may say yes wrongly, never no. Rows reach the driver as at most
    2**(bits - 16) chunks of 8 KB."""
    at = F.shiftrightunsigned(column, HASH_BITS - bits)
    dealt = values.select(F.shiftright(at, _CHUNK_BITS).cast("int").alias("chunk"), at.bitwiseAND((1 << _CHUNK_BITS) - 1).cast("int").alias("bit"))

    def fill(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, bit = batch["chunk"].to_numpy(), batch["bit"].to_numpy()
            for c in np.unique(chunk):
                found.setdefault(int(c), np.zeros(1 << _CHUNK_BITS, bool))[bit[chunk == c]] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([np.packbits(b, bitorder="little").tobytes() for b in found.values()],
                                                         pa.binary())], ["chunk", "bits"])

    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = np.zeros(1 << (bits - 3), np.uint8)
    width = 1 << (_CHUNK_BITS - 3)
    chunks = dealt.distinct().repartition(n, "chunk").mapInArrow(fill, "chunk int, bits binary")
    for r in chunks.collect():  # 2**(bits - 3) bytes at most
        whole[r["chunk"] * width:(r["chunk"] + 1) * width] |= np.frombuffer(r["bits"], np.uint8)
    return whole


def in_bit_set(whole: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = (h >> np.uint64(HASH_BITS - bits)).astype(np.int64)
    return ((whole[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def ordered(g: np.ndarray, sizes: np.ndarray, common: list[np.ndarray], bits: int):
    """The rows' sets in the global order (frequency class above the hash) and each entry's row."""
    level = np.zeros(len(g), np.uint64)
    for whole in common:
        level += in_bit_set(whole, g, bits)
    g = g | (level << np.uint64(HASH_BITS))
    row = np.repeat(np.arange(len(sizes)), sizes)
    return g[np.lexsort((g, row))], row


def cells(t: np.ndarray, block: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of an n-gram in its two cells: blocks (0, 1), (2, 3), ... and (1, 2), (3, 4), ...

    Postings of the same or of neighbouring blocks have a cell in common."""
    tag = lambda c, odd: ((c << 1) | odd).astype(np.uint64) * _SALT
    return tuple(mix64(t ^ tag((block + odd) >> 1, odd)) >> np.uint64(64 - bits) for odd in (0, 1))


def crowded_cells(classes: DataFrame, ratio: float, bits: int) -> np.ndarray:
    """Bit set (2**bits bits, a fixed size) of the cells with more than one posting.

    Cells are counted at 16 times its resolution, in 2**_PARTS parts; positions within a part travel
    sorted, three bytes each, by byte planes. It may say yes wrongly, never no."""
    width = bits + 4 - _PARTS  # bits of a position within its part, at most 24
    planes = range(3)

    def pack(found):
        at = np.sort(np.concatenate(found))
        keep = np.ones(len(at), bool)
        keep[2:] = at[2:] != at[:-2]
        at = at[keep]
        part, first = np.unique(at >> np.uint64(width), return_index=True)
        lists = np.split((at & np.uint64((1 << width) - 1)).astype(np.uint32), first[1:])
        body = [b"".join((x >> np.uint32(8 * i)).astype(np.uint8).tobytes() for i in planes) for x in lists]
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(body, pa.binary())], ["part", "body"])

    def deal(batches):
        found, size = [], 0
        for batch in batches:
            t, row, block, _ = flat_prefixes(batch, ratio)
            found.extend(cells(t, block[row], bits + 4))
            size += 2 * len(t)
            if size >= 4_000_000:
                yield pack(found)
                found, size = [], 0
        if size:
            yield pack(found)

    def count(batches):
        at, once, twice = None, None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array(
            [np.packbits(twice.reshape(-1, 16).any(axis=1), bitorder="little").tobytes()], pa.binary())], ["part", "bits"])
        for batch in batches:
            for part, body in zip(batch["part"].to_pylist(), batch["body"]):
                if part != at:
                    if at is not None:
                        yield done()
                    at, once, twice = part, np.zeros(1 << width, bool), np.zeros(1 << width, bool)
                plane = np.frombuffer(body.as_py(), np.uint8).reshape(3, -1).astype(np.uint32)
                position = sum(plane[i] << np.uint32(8 * i) for i in planes)
                twice[position[once[position]]] = True
                twice[position[1:][position[1:] == position[:-1]]] = True
                once[position] = True
        if at is not None:
            yield done()

    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = classes.select("n", "prefix").mapInArrow(deal, "part int, body binary").repartition(n, "part").sortWithinPartitions("part")
    whole = np.zeros(1 << (bits - 3), np.uint8)
    size = len(whole) >> _PARTS
    for r in dealt.mapInArrow(count, "part int, bits binary").collect():  # 2**(bits - 3) bytes at most
        whole[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return whole


def flat_prefixes(batch: pa.RecordBatch, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The prefix n-grams of all rows, each one's row, the rows' blocks (by set size) and prefix lengths."""
    size = np.diff(batch["prefix"].offsets.to_numpy())
    block = np.floor(np.log(batch["n"].to_numpy()) / ratio).astype(np.int64)
    return batch["prefix"].flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(size)), size), block, size


def min_hashes(g: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MINHASHES smallest mixed members per row; two sets share each with probability Jaccard."""
    out = np.zeros((len(sizes), MINHASHES), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        at = (np.cumsum(sizes) - sizes)[some]
        for i in range(MINHASHES):
            out[some, i] = np.minimum.reduceat(mix64(g ^ (_SALT >> np.uint64(i + 1))), at)
    return out.view(np.int64)


def parity_sketch(g: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS words per row whose bits are the parities of the members in each of 256 bins:
    two sets' sketches differ in at most as many bits as the sets differ in members."""
    out = np.zeros((len(sizes), SKETCH_WORDS), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        at = (np.cumsum(sizes) - sizes)[some]
        bit = np.uint64(1) << (g & np.uint64(63))
        word = (g >> np.uint64(6)) & np.uint64(SKETCH_WORDS - 1)
        for w in range(SKETCH_WORDS):
            out[some, w] = np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), at)
    return out.view(np.int64)


class JaccardJoin:
    """Links documents whose n-gram sets have den * |intersection| >= num * |union|."""

    def __init__(self, docs: DataFrame, key: str, text: str, n: int, num: int, den: int, common: tuple[int, ...], bits: int):
        self.docs = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
        self.n, self.num, self.den, self.common, self.bits = n, num, den, common, bits
        self.loose = max(1, num - (den - num + 1) // 2)  # a threshold that sets which just fail to link meet
        self.spark = docs.sparkSession

    def common_grams(self):
        """Broadcast bit sets, one per frequency class: n-grams in more than so many prefixes by
        hash order (these hold about a tenth to a fifth of each set). Where a fixed-size set would
        fill up, its limit doubles."""
        n, num, den = self.n, self.num, self.den

        def count(batches):
            grams, size = [], 0
            for batch in batches:
                for _, _, g, sizes in shingle_sets(batch["text"], n):
                    rank = np.arange(len(g)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    grams.append(g[rank < np.repeat(prefix_lengths(sizes, num, den), sizes)])
                    size += len(grams[-1])
                    if size >= 2_000_000:
                        yield from pack(grams)
                        grams, size = [], 0
            yield from pack(grams)

        def pack(grams):
            h, k = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]), return_counts=True)
            for lo in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(h[lo:lo + 100_000].view(np.int64)), pa.array(k[lo:lo + 100_000].astype(np.int64))],
                                                 ["h", "k"])

        counts = self.docs.select("text").mapInArrow(count, "h long, k long").groupBy("h").agg(F.sum("k").alias("k"))
        counts = shared_table(counts.where(F.col("k") > self.common[0]), "common")
        sizes = {r["level"]: r["n"] for r in counts.groupBy(F.floor(F.log2("k")).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
        sets = []
        for limit in self.common:
            while sum(c for level, c in sizes.items() if 2 ** (level + 1) > limit + 1) > (1 << self.bits) // 8:
                limit *= 2
            sets.append(bit_set(counts.where(F.col("k") > limit), "h", self.bits))
        discard(counts)
        return self.spark.sparkContext.broadcast(sets)

    def prefixes(self, common) -> DataFrame:
        """(doc_id, n, d1, d2, sketch, hashes, prefix) of every document; d1 and d2 identify the set."""
        n, num, den, bits = self.n, self.num, self.den, self.bits

        def run(batches):
            for batch in batches:
                for lo, hi, g, sizes in shingle_sets(batch["text"], n):
                    d1, d2 = set_digests(g, sizes)
                    rows = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
                    sketch, hashes = rows(parity_sketch(g, sizes)), rows(min_hashes(g, sizes))
                    g, row = ordered(g, sizes, common.value, bits)
                    take = prefix_lengths(sizes, num, den)
                    rank = np.arange(len(g)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]).astype(np.int32)),
                                                     pa.array(g[rank < take[row]].view(np.int64)))
                    yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(sizes), pa.array(d1), pa.array(d2), sketch, hashes, lists],
                                                     ["doc_id", "n", "d1", "d2", "sketch", "hashes", "prefix"])

        return self.docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, sketch array<long>, hashes array<long>, prefix array<long>")

    def sets(self, needed: DataFrame, common) -> DataFrame:
        """(cid, s): the whole sets of the classes in ``needed`` (cid, low, d1, d2), each from the
        text of its smallest key, so that copies are neither sent nor stored."""
        n, bits = self.n, self.bits
        mark = F.col("d1").bitwiseXOR(F.shiftleft(F.coalesce("low", F.lit(0).cast("long")), 40))
        wanted = self.spark.sparkContext.broadcast(bit_set(needed.select(F.shiftrightunsigned(mark, 64 - HASH_BITS).alias("h")), "h", bits))

        def run(batches):
            for batch in batches:
                for lo, hi, g, sizes in shingle_sets(batch["text"], n):
                    d1, d2 = set_digests(g, sizes)
                    keys = batch["doc_id"].slice(lo, hi - lo)
                    at = keys.fill_null(0).to_numpy().view(np.uint64) << np.uint64(40)
                    want = in_bit_set(wanted.value, (d1.view(np.uint64) ^ at) >> np.uint64(64 - HASH_BITS), bits) & (sizes > 0)
                    if not want.any():
                        continue
                    g = g[np.repeat(want, sizes)]
                    g, _ = ordered(g, sizes[want], common.value, bits)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes[want])]).astype(np.int32)), pa.array(g.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([keys.filter(pa.array(want)), pa.array(d1[want]), pa.array(d2[want]), lists],
                                                     ["doc_id", "d1", "d2", "s"])

        found = self.docs.mapInArrow(run, "doc_id long, d1 long, d2 long, s array<long>").withColumnsRenamed({"d1": "f1", "d2": "f2"})
        same = (F.col("d1") == F.col("f1")) & (F.col("d2") == F.col("f2")) & F.col("low").eqNullSafe(F.col("doc_id"))
        sets = shared_table(found.join(needed, same).select("cid", "s"), "sets")
        # rows that repeat both key and text
        again = shared_table(sets.groupBy("cid").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("cid"), "again")
        if not again.isEmpty():
            once = shared_table(sets.join(again, "cid", "left_anti").union(sets.join(again, "cid").groupBy("cid").agg(F.any_value("s"))), "sets")
            discard(sets)
            sets = once
        discard(again)
        return sets

    def enough(self, overlap, a, b, num: int | None = None):
        num = num or self.num
        return overlap * (num + self.den) >= (a + b) * num

    def sizes_fit(self, a, b, num: int | None = None):
        return (F.least(a, b) * self.den) >= F.greatest(a, b) * (num or self.num)

    def prefix_filter(self, pairs: DataFrame, classes: DataFrame, name: str, num: int | None = None) -> DataFrame:
        """Pairs (x, y, ...) that the prefixes don't rule out at threshold ``num``, with nx and ny, as a
        table called ``name``.

        What one prefix has up to the end of the shorter-reaching one and the other lacks, the
        other set lacks."""
        pairs = shared_table(pairs, "pairs")
        # the prefixes of classes in no pair aren't moved (Spark broadcasts the ids if small by its own limit)
        ids = shared_table(pairs.select(F.col("x").alias("cid")).union(pairs.select("y")).distinct(), "ids")
        side = classes.select("cid", "n", "prefix").join(ids, "cid", "left_semi")
        p = (pairs.join(side.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("prefix").alias("px")), "x")
             .join(side.select(F.col("cid").alias("y"), F.col("n").alias("ny"), F.col("prefix").alias("py")), "y"))
        p = p.withColumn("reach", F.least(F.element_at("px", -1), F.element_at("py", -1)))
        lost = lambda a, b: F.size(F.filter(F.array_except(a, b), lambda t: t <= F.col("reach")))
        good = (self.enough(F.col("nx") - lost("px", "py"), F.col("nx"), F.col("ny"), num)
                & self.enough(F.col("ny") - lost("py", "px"), F.col("nx"), F.col("ny"), num))
        out = shared_table(p.where(self.sizes_fit(F.col("nx"), F.col("ny"), num) & good).drop("px", "py", "reach"), name)
        discard(pairs, ids)
        return out

    def compare(self, pairs: DataFrame, classes: DataFrame, common) -> DataFrame:
        """Pairs (x, y, nx, ny) with their overlap, from the whole sets, and both differences (dx, dy)
        of highly similar ones, as a table."""
        needed = pairs.select(F.col("x").alias("cid")).union(pairs.select("y")).distinct()
        needed = shared_table(needed.join(classes.select("cid", "low", "d1", "d2"), "cid"), "needed")
        sets = self.sets(needed, common)
        p = (pairs.join(sets.select(F.col("cid").alias("x"), F.col("s").alias("sx")), "x")
             .join(sets.select(F.col("cid").alias("y"), F.col("s").alias("sy")), "y"))
        p = p.withColumns({"dx": F.array_except("sx", "sy"), "dy": F.array_except("sy", "sx")}).drop("sx", "sy")
        p = p.withColumn("overlap", F.col("nx") - F.size("dx"))
        # differences of sets that aren't highly similar are long and of no use to others
        close = F.col("overlap") * self.den >= F.greatest("nx", "ny") * (2 * self.num - self.den)
        p = p.select("x", "y", "nx", "ny", "overlap", F.when(close, F.col("dx")).alias("dx"), F.when(close, F.col("dy")).alias("dy"))
        out = shared_table(p, "compared")
        discard(needed, sets)
        return out

    def run(self) -> DataFrame:
        common = self.common_grams()
        per_doc = shared_table(self.prefixes(common), "prefixes")
        rows = shared_table(per_doc.select("doc_id", "n", "d1", "d2"), "rows")
        classes = per_doc.where("n > 0").groupBy("n", "d1", "d2").agg(F.any_value(F.struct("sketch", "hashes", "prefix")).alias("v"), F.min("doc_id").alias("low"))
        classes = classes.select("n", "d1", "d2", "v.sketch", "v.hashes", "v.prefix", "low", F.monotonically_increasing_id().alias("cid"))
        classes = shared_table(classes, "classes")
        discard(per_doc)
        component = self.components(classes, common)
        lowest = (classes.select(F.col("cid").alias("id"), "low").join(component, "id").groupBy("component_id")
                  .agg(F.min("low").alias("lowest")))
        component = component.join(lowest, "component_id").select("id", "lowest")
        named = (classes.select("n", "d1", "d2", "low", F.col("cid").alias("id")).join(component, "id", "left")
                 .select("n", "d1", "d2", F.coalesce("lowest", "low").alias("component_id")))
        named = shared_table(named, "named")
        discard(classes)
        matched = rows.where("n > 0").join(named, ["n", "d1", "d2"]).select("doc_id", "n", "component_id")
        empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
        return matched.union(empty).withColumnRenamed("n", "n_shingles")

    def components(self, classes: DataFrame, common) -> DataFrame:
        """(id, component_id) of the classes that are linked with others."""
        ratio, bits = math.log(self.den / self.num), self.bits + 2
        crowded = self.spark.sparkContext.broadcast(crowded_cells(classes, ratio, bits))

        def postings(batches):
            for batch in batches:
                t, row, block, size = flat_prefixes(batch, ratio)
                here, next_ = cells(t, block[row], bits)
                shift = np.uint64(HASH_BITS - bits)
                at = np.flatnonzero(in_bit_set(crowded.value, here << shift, bits) | in_bit_set(crowded.value, next_ << shift, bits))
                pos = np.arange(len(t)) - np.repeat(np.cumsum(size) - size, size)
                for lo in range(0, len(at), 50_000):
                    a = at[lo:lo + 50_000]
                    take = pa.array(row[a])
                    before = [pa.array(t[a - i].view(np.int64), mask=pos[a] < i) for i in (1, 2)]
                    yield pa.RecordBatch.from_arrays([pa.array(t[a].view(np.int64)), pa.array(pos[a].astype(np.int32)), pa.array(block[row[a]].astype(np.int32)),
                                                      *(batch[c].take(take) for c in ("cid", "n", "sketch")), *before],
                                                     ["t", "pos", "block", "cid", "n", "sketch", "p1", "p2"])

        # p1 and p2: the two n-grams before this one in the set's prefix
        lists = classes.select("cid", "n", "sketch", "prefix").mapInArrow(
            postings, "t long, pos int, block int, cid long, n long, sketch array<long>, p1 long, p2 long")
        lists = shared_table(lists, "lists")

        # 1. every member against its block's leaders
        entry = F.struct("cid", "n", "pos", "sketch")
        first_of = [F.min_by(entry, F.xxhash64(F.lit(i), "cid")) for i in range(LEADERS)]
        # central: the fewest rarer n-grams before this one, as members have them of their own
        hub = F.min_by(entry, F.struct("pos", "n", "cid"))
        lead = (lists.groupBy("t", "block").agg(F.count(F.lit(1)).alias("k"), F.array(hub, *first_of).alias("leads")).where("k > 1"))
        hub = F.when(F.col("k") >= HUB, F.get("leads", F.lit(0))["cid"])
        lead = shared_table(lead.select("t", "block", hub.alias("hub"), F.array_distinct("leads").alias("leads")), "leaders")
        star = (lists.join(lead.select("t", "block", "hub", F.explode("leads").alias("lead")), ["t", "block"]).where("cid <> lead.cid")
                .where(self.may_link("lead.pos", "lead.n", "lead.sketch", "pos", "n", "sketch")
                       | (F.coalesce(F.col("hub") == F.col("lead.cid"), F.lit(False)) & self.sizes_fit(F.col("n"), F.col("lead.n"), self.loose)
                          & self.may_link("lead.pos", "lead.n", "lead.sketch", "pos", "n", "sketch", self.loose)))
                .select(F.least("lead.cid", "cid").alias("x"), F.greatest("lead.cid", "cid").alias("y")).distinct())
        # and of the blocks of sets with a min-hash in common, where highly similar sets meet at once
        alike = classes.select(F.posexplode("hashes").alias("i", "t"), "cid", "n", "sketch", F.lit(0).alias("pos"))
        heads = (alike.groupBy("i", "t").agg(F.count(F.lit(1)).alias("k"), F.min_by(entry, "cid").alias("lead")).where("k > 1"))
        alike = (alike.join(heads, ["i", "t"]).where("cid <> lead.cid")
                 .where(self.may_link("lead.pos", "lead.n", "lead.sketch", "pos", "n", "sketch"))
                 .select(F.least("lead.cid", "cid").alias("x"), F.greatest("lead.cid", "cid").alias("y")))
        star = self.prefix_filter(star.union(alike).distinct(), classes, "star", self.loose)
        first = self.compare(star, classes, common)
        discard(star)
        label = connected_components(first.where(self.enough(F.col("overlap"), F.col("nx"), F.col("ny"))), "x", "y")
        # each member's differences to one leader: the one that most sets are highly similar to
        close = first.where("dx is not null")
        ends = (close.select(F.col("x").alias("leader"), F.col("nx").alias("n_leader"), F.col("y").alias("cid"))
                .union(close.select("y", "ny", "x")))
        many = ends.groupBy("leader", "n_leader").agg(F.count(F.lit(1)).alias("k"))
        ends = ends.join(many, ["leader", "n_leader"]).union(many.select("leader", "n_leader", F.col("leader").alias("cid"), "k"))
        best = ends.groupBy("cid").agg(F.max_by(F.struct("leader", "n_leader"), F.struct("k", -F.col("leader"))).alias("v")).select("cid", "v.*")
        best = shared_table(best, "best")
        none = F.array().cast("array<long>")
        own = best.where("cid = leader").select("cid", "leader", none.alias("lost"), none.alias("new"), "n_leader")
        of = lambda leader, cid, lost, new: (
            close.select(F.col(leader).alias("leader"), F.col(cid).alias("cid"), F.col(lost).alias("lost"), F.col(new).alias("new"))
            .join(best, ["cid", "leader"]).select("cid", "leader", "lost", "new", "n_leader"))
        known = of("x", "y", "dx", "dy").union(of("y", "x", "dy", "dx")).union(own)
        known = shared_table(known, "known")
        discard(first, best)

        # 2. of the members with a leader, those outside the list's main component against another of
        # that, by both sets' differences to a common leader; each list has a member of its own for this
        mixed = shared_table(self.mixed_lists(lists.select("t", "cid", "n").join(known.select("cid", "leader"), "cid"), label), "mixed")
        other = (mixed.where("comp = main").groupBy("t", "leader")
                 .agg(F.min_by(F.struct("cid", "n"), F.xxhash64("t", "cid")).alias("o")))
        near = (mixed.where("comp <> main").join(other, ["t", "leader"]).where(self.sizes_fit(F.col("n"), F.col("o.n")))
                .select(F.col("o.cid").alias("x"), F.col("cid").alias("y"), F.col("o.n").alias("nx"), F.col("n").alias("ny")).distinct())
        near = self.derive(near, known).where(self.enough(F.col("overlap"), F.col("nx"), F.col("ny"))).select("x", "y")
        label = merged_components(label, near)
        discard(mixed)

        # 3. all pairs of different components that are still open
        leaders = lead.select("t", "block", F.explode("leads.cid").alias("cid"), F.lit(True).alias("leads"))
        mixed = self.mixed_lists(lists, label).join(leaders, ["t", "block", "cid"], "left").join(known.select("cid", "leader"), "cid", "left")
        mixed = shared_table(mixed.withColumn("leads", F.coalesce("leads", F.lit(False))), "mixed")
        discard(lists, lead)
        side = ("cid", "n", "pos", "sketch", "block", "comp", "leads", "leader", "p1", "p2")
        strip = lambda c: F.floor(c / STRIP).cast("int")
        a = mixed.where("comp <> main").select("t", *[F.col(c).alias(f"a_{c}") for c in side])
        b = mixed.select("t", strip(F.col("block")).alias("at"), "main", *[F.col(c).alias(f"b_{c}") for c in side])
        # sets that can link stand in the same block or in neighbouring ones
        a = a.withColumn("at", F.explode(F.array_distinct(F.array(*[strip(F.col("a_block") + i) for i in (-1, 1)]))))
        # a pair that shares one of the n-grams before meets in that list as well, under a weaker filter
        # (or a leader has decided it there): similar sets share most of a prefix, so this list needn't have it
        met = F.coalesce(F.col("a_p1").isin(F.col("b_p1"), F.col("b_p2")), F.lit(False)) | F.coalesce(
            F.col("a_p2").isin(F.col("b_p1"), F.col("b_p2")), F.lit(False))
        together = F.coalesce(F.col("a_leader") == F.col("b_leader"), F.lit(False))  # these meet by their differences
        apart = (~met & ~together & (F.col("a_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("main")) | (F.col("a_cid") < F.col("b_cid")))
                 & ~((F.col("a_block") == F.col("b_block")) & (F.col("a_leads") | F.col("b_leads")))
                 & self.sizes_fit(F.col("a_n"), F.col("b_n")) & self.may_link("a_pos", "a_n", "a_sketch", "b_pos", "b_n", "b_sketch"))
        first_is_a = F.col("a_cid") < F.col("b_cid")
        pair = (F.least("a_cid", "b_cid").alias("x"), F.greatest("a_cid", "b_cid").alias("y"),
                F.when(first_is_a, F.col("a_n")).otherwise(F.col("b_n")).alias("nx"),
                F.when(first_is_a, F.col("b_n")).otherwise(F.col("a_n")).alias("ny"))
        rest = a.join(b, ["t", "at"]).where(apart).select(*pair).union(self.meet_by_differences(known, label).select(*pair)).distinct()
        rest = shared_table(self.derive(rest, known), "rest")
        discard(mixed, known)
        late = rest.where(self.enough(F.col("overlap"), F.col("nx"), F.col("ny"))).select("x", "y")
        open_ = self.prefix_filter(rest.where("overlap is null").select("x", "y"), classes, "open")
        done = [rest, open_]
        if not open_.isEmpty():
            second = self.compare(open_, classes, common)
            late = late.union(second.where(self.enough(F.col("overlap"), F.col("nx"), F.col("ny"))).select("x", "y"))
            done.append(second)
        label = merged_components(label, late)
        discard(*done)
        return label

    def meet_by_differences(self, known: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs (a_cid, b_cid, a_n, b_n, with repeats) of different components that have the same leader
        and may link.

        One of the two (a) isn't linked with the leader, or both were of one component. They differ
        in what exactly one of them has as a difference to the leader, so they link only if enough of
        their differences are the same. The first of these, in an order of the differences with the
        leader's own n-grams last, leaves enough behind it in either; what a lacks to link with
        the leader bounds how far back it can stand in b."""
        both, gap = self.num + self.den, self.den - self.num
        count = F.size("lost") + F.size("new")
        n = F.col("n_leader") - F.size("lost") + F.size("new")
        k = known.join(label.select(F.col("id").alias("cid"), "component_id"), "cid", "left")
        k = k.select("cid", "leader", F.coalesce("component_id", "cid").alias("comp"), n.alias("n"), count.cast("long").alias("d"),
                     self.enough(F.col("n_leader") - F.size("lost"), n, F.col("n_leader")).alias("linked"), "n_leader",
                     F.concat(F.array_sort("new"), F.array_sort("lost")).alias("all"))
        k = k.withColumn("bins", F.array(*[occupied_bins("all", w) for w in range(SKETCH_WORDS)]))
        k = k.withColumn("over", F.col("d") - sum(F.bit_count(F.get("bins", F.lit(w))) for w in range(SKETCH_WORDS)))
        mixed = k.groupBy("leader").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("leader")
        k = k.join(mixed, "leader")
        spread = lambda df, c, some: df.select(
            "leader", F.posexplode(some).alias(f"{c}_i", "e"), *[F.col(x).alias(f"{c}_{x}") for x in ("cid", "comp", "n", "d", "linked", "bins", "over")])
        least = F.floor((F.col("d") * both + (F.col("n_leader") - F.col("n")) * gap) / (2 * both))  # a pair has more in common
        a = spread(k.where("not linked"), "a", F.col("all"))
        b = spread(k, "b", F.slice("all", F.lit(1), F.greatest(F.lit(0), F.col("d") - least).cast("int")))
        rest = F.least(F.col("a_d") - F.col("a_i"), F.col("b_d") - F.col("b_i"))
        # in common: at most one for each bin that both occupy, and what one set has in its bins beyond one each
        most = F.least("a_over", "b_over") + sum(
            F.bit_count(F.get("a_bins", F.lit(w)).bitwiseAND(F.get("b_bins", F.lit(w)))) for w in range(SKETCH_WORDS))
        return (a.join(b, ["leader", "e"])
                .where((F.col("a_comp") != F.col("b_comp")) & (F.col("b_linked") | (F.col("a_cid") < F.col("b_cid")))
                       & self.sizes_fit(F.col("a_n"), F.col("b_n"))
                       & (F.least(rest, most) * (2 * both) >= (F.col("a_d") + F.col("b_d")) * both - (F.col("a_n") + F.col("b_n")) * gap))
                .select("a_cid", "b_cid", "a_n", "b_n"))

    def mixed_lists(self, lists: DataFrame, label: DataFrame) -> DataFrame:
        """Postings of the lists with several components, with component and the list's main (most
        frequent) one."""
        label = label.withColumnRenamed("id", "cid")
        comp = lambda df: df.join(label, "cid", "left").withColumn("comp", F.coalesce("component_id", "cid")).drop("component_id")
        main = (comp(lists.select("t", "cid")).groupBy("t", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("t")
                .agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1"))
        return comp(lists).join(main.drop("parts"), "t")

    def derive(self, pairs: DataFrame, known: DataFrame) -> DataFrame:
        """Pairs (x, y, nx, ny) with the overlap that follows from both sets' differences to a
        common leader, NULL where there is none."""
        of = lambda c: known.select(*[F.col(k).alias(f"{c}_{k}") for k in ("cid", "leader", "lost", "new", "n_leader")])
        p = (pairs.join(of("x"), F.col("x") == F.col("x_cid"), "left").join(of("y"), F.col("y") == F.col("y_cid"), "left"))
        overlap = (F.col("x_n_leader") - F.size(F.array_union("x_lost", "y_lost")) + F.size(F.array_intersect("x_new", "y_new")))
        return p.select("x", "y", "nx", "ny", F.when(F.col("x_leader") == F.col("y_leader"), overlap).alias("overlap"))

    def may_link(self, pos_a: str, n_a: str, sketch_a: str, pos_b: str, n_b: str, sketch_b: str, num: int | None = None):
        """Whether the rest of both sets, from this n-gram on, could be enough if it is their first
        common one, and the sketches allow the threshold."""
        best = F.least(F.col(n_a) - F.col(pos_a), F.col(n_b) - F.col(pos_b))
        words = [F.bit_count(F.get(sketch_a, F.lit(w)).bitwiseXOR(F.get(sketch_b, F.lit(w)))) for w in range(SKETCH_WORDS)]
        differ = sum(words[1:], words[0])
        # members in only one of the sets: at most (n_a + n_b) (den - num) / (den + num)
        num = num or self.num
        return (self.enough(best, F.col(n_a), F.col(n_b), num)
                & (differ * (self.den + num) <= (F.col(n_a) + F.col(n_b)) * (self.den - num)))


def occupied_bins(column: str, word: int):
    """Word ``word`` of the SKETCH_WORDS words whose bits say in which of as many bins members fall."""
    bit = lambda e: F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(63).cast("int"))
    here = lambda e: F.shiftright(e, 6).bitwiseAND(SKETCH_WORDS - 1) == word
    return F.aggregate(column, F.lit(0).cast("long"), lambda x, e: F.when(here(e), x.bitwiseOR(bit(e))).otherwise(x))


def merged_components(label: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, component_id) after more links (x, y): only the components that these join
    are searched again, as single nodes."""
    of = lambda c: label.select(F.col("id").alias(c), F.col("component_id").alias(f"{c}_root"))
    joined = links.join(of("x"), "x", "left").join(of("y"), "y", "left")
    top = connected_components(joined.select(F.coalesce("x_root", "x").alias("a"), F.coalesce("y_root", "y").alias("b")))
    moved = label.join(top.select(F.col("id").alias("component_id"), F.col("component_id").alias("top")), "component_id", "left")
    moved = moved.select("id", F.coalesce("top", "component_id").alias("component_id"))
    return shared_table(moved.union(top.join(label, "id", "left_anti").select("id", "component_id")), "labels")


def set_digests(g: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over mixed members, per row."""
    out = []
    at = np.cumsum(sizes) - sizes
    for salt in (np.uint64(0), _SALT):
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(g ^ salt))])
            out.append(mix64(total[at + sizes] - total[at] + salt).view(np.int64))
    return out[0], out[1]


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100,
                       common: tuple[int, ...] = (1, 8, 64), bits: int = 26) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Words are ``[^\\\\x20\\\\x09-\\\\x0D]+`` after lower-casing A-Z; a set holds the distinct runs of
    ``words`` words of the whole text, or the whole sequence if it is shorter. Documents link when
    den * intersection >= num * union; component_id is the smallest key reachable. NULL, empty and
    wordless texts have an empty set and link with nothing; equal texts and repeated rows share a
    component; NULL keys are ignored in the smallest (component_id is NULL if all are). Extra
    columns are ignored; an empty table gives no rows. ``common`` (limits of the frequency
    classes, at most three) and ``bits`` (size of each bit set, 8 MB; four times that for the
    index cells) steer only the work."""
    return JaccardJoin(docs, key, text, words, num, den, common, bits).run()


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the row whose key is its
    component_id. Rows with a NULL key stay only if their component has no other key; of rows that
    repeat the key of a staying row all but the first by the other columns go."""
    found = jaccard_components(docs, key, text, **options)
    keys = found.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stay"), F.count(F.lit(1)).alias("n"))
    keys = shared_table(keys.where("not stay or n > 1").withColumnRenamed("doc_id", "__id"), "keys")
    same = docs[key].cast("long").eqNullSafe(F.col("__id"))
    # few keys go, so Spark may broadcast them by its own size limit; texts are moved only for repeated keys
    kept = docs.join(keys.where("not stay"), same, "left_anti")
    repeated = keys.where("stay").select("__id")
    w = Window.partitionBy("__id").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c not in (key, text)], F.col(f"`{text}`"))
    first = kept.join(repeated, same).withColumn("__nr", F.row_number().over(w)).where(F.col("__nr") == 1)
    return kept.join(repeated, same, "left_anti").union(first.select(*[F.col(f"`{c}`") for c in docs.columns]))
