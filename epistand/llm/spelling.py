"""Spelling variants: words one edit apart, by search schemes on a bidirectional FM-index.

Words are counted over all texts. One edit leaves the first or the second half of a word as it is,
so a word meets its near words among the words that share that half. Every word is dealt to the
tasks of the halves that words up to one letter longer or shorter could share with it. A task joins
its words, delimited, to one text and indexes it in both directions: suffix ranks (prefix doubling)
and wavelet matrices of the two Burrows-Wheeler transforms, so that an interval of suffix ranks is
extended to either side in step. Each word then runs two search schemes: one half matched exactly
away from the other half up to the delimiter, then extended across the other half with one error.
All words of a task are searched together, a letter at a time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import mix64, shared_table, text_blocks

SCAN_BYTES = 8 << 20  # text whose runs are counted together
TASK_WORDS = 50_000  # dealt words a task indexes, about
CELLS = 2_000_000  # letters of the words searched together


# ---- words -------------------------------------------------------------------------------------

def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


def run_crcs(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, continued from the crc32 ``state`` of what stands before it."""
    table, out = _crc_table(), state.astype(np.uint32).copy()
    for k in np.flatnonzero(lens > 64).tolist():
        out[k] = zlib.crc32(data[starts[k]:starts[k] + lens[k]].tobytes(), int(state[k]))
    order = np.argsort(np.where(lens > 64, 0, -lens), kind="stable")
    reg = ~out[order]
    at, sizes = starts[order], np.where(lens > 64, 0, lens)[order]
    live = len(order)
    for t in range(int(sizes[0]) if live else 0):
        live = int(np.searchsorted(-sizes, -t, side="left"))  # runs longer than t
        r = reg[:live]
        reg[:live] = table[(r ^ data[at[:live] + t]) & np.uint32(0xFF)] ^ (r >> np.uint32(8))
    short = lens[order] <= 64
    out[order[short]] = ~reg[short]
    return out


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` in UTF-8, and their rows."""
    low = data | 0x20
    lead = data == 0xC3  # U+00C0 to U+00FF are the characters that begin with this byte
    letter = ((low >= 97) & (low <= 122)) | lead
    letter[1:] |= lead[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(letter & (~np.concatenate([[False], letter[:-1]]) | cut[:-1]))
    ends = np.flatnonzero(letter & (~np.concatenate([letter[1:], [False]]) | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def block_words(data: np.ndarray, offsets: np.ndarray, keys: list, min_letters: int, drop_every: int) -> list[pa.Array]:
    """(word, n) arrays of a block: runs with A-Z lower-cased; where ``drop_every`` divides the crc32
    h of ``<key>:<run>``, the run's code point number h % length is left out."""
    if not len(data):
        return []
    starts, ends, row = letter_runs(data, offsets)
    lens = ends - starts
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)
    seed = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in keys], np.uint32)
    h = run_crcs(data, starts, lens, seed[row]) if drop_every else np.ones(len(starts), np.uint32)
    two = np.concatenate([[0], np.cumsum(data == 0xC3)])
    letters = lens - (two[ends] - two[starts])
    hit = (h % np.uint32(drop_every) == 0) if drop_every else np.zeros(len(starts), bool)
    changed: Counter = Counter()
    for k in np.flatnonzero(hit & (letters > min_letters)).tolist():
        word = data[starts[k]:ends[k]].tobytes().decode()
        at = int(h[k]) % len(word)
        changed[word[:at] + word[at + 1:]] += 1
    keep = ~hit & (letters >= min_letters)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[keep]] += 1
    edge[ends[keep]] -= 1
    kept = np.ascontiguousarray(data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)])
    bounds = np.concatenate([[0], np.cumsum(lens[keep])]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(kept))
    counted = words.value_counts()
    return [pa.concat_arrays([counted.field(0).cast(pa.string()), pa.array(list(changed), pa.string())]),
            pa.concat_arrays([counted.field(1), pa.array(list(changed.values()), pa.int64())])]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = 5, min_count: int = 3,
                drop_every: int = 97) -> DataFrame:
    """(word, n) of the words with at least ``min_letters`` code points and ``min_count`` occurrences
    in all texts. A null text has no words, a null key is empty; repeated rows count each. Texts are
    read whole. ``drop_every`` (0: never) plants variants, see ``block_words``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1), SCAN_BYTES):
                columns = block_words(data, offsets, batch.column(0).slice(lo, hi - lo).to_pylist(), min_letters, drop_every)
                if columns:
                    yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    found = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(
        scan, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- bidirectional FM-index ----------------------------------------------------------------------

def suffix_ranks(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array by prefix doubling, from as many first letters as 62 bits hold."""
    n, bits = len(text), max(1, int(symbols).bit_length())
    step = 62 // bits
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(step, np.int64)])  # 0: past the end
    for i in range(step):
        key = (key << bits) | padded[i:i + n]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if n == 0 or new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new + 1
        key = rank * (n + 2) + np.concatenate([rank[step:], np.zeros(min(step, n), np.int64)])[:n]
        step *= 2


class Wavelet:
    """Wavelet matrix of a sequence: ranks and counts of smaller letters of many intervals at once."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.zeros, self.total = [], []
        for level in range(self.bits - 1, -1, -1):
            one = ((seq >> level) & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            self.total.append(int(self.zeros[-1][-1]))
            seq = np.concatenate([seq[~one], seq[one]])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))])[:symbols]
        c = np.arange(symbols)
        self.start = self._down(np.zeros(symbols, np.int64), np.zeros(symbols, np.int64), c)[0]

    def _down(self, lo, hi, c):
        less = np.zeros(len(lo), np.int64)
        for level, (zero, total) in enumerate(zip(self.zeros, self.total, strict=True)):
            one = ((c >> (self.bits - 1 - level)) & 1).astype(bool)
            zl, zh = zero[lo].astype(np.int64), zero[hi].astype(np.int64)
            less += np.where(one, zh - zl, 0)
            lo, hi = np.where(one, total + lo - zl, zl), np.where(one, total + hi - zh, zh)
        return lo, hi, less

    def step(self, lo, size, c):
        """Interval start and size after letter ``c``, and the letters below ``c`` in the interval."""
        a, b, less = self._down(lo, lo + size, c)
        return self.first[c] + a - self.start[c], b - a, less

    def letters(self, lo, size):
        """Every distinct letter of each interval: (interval, letter, start, size, smaller ones)."""
        src, c = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        hi, less = lo + size, np.zeros(len(lo), np.int64)
        for zero, total in zip(self.zeros, self.total, strict=True):
            zl, zh = zero[lo].astype(np.int64), zero[hi].astype(np.int64)
            ol, oh = total + lo - zl, total + hi - zh
            z, o = zh > zl, oh > ol
            src = np.concatenate([src[z], src[o]])
            less = np.concatenate([less[z], less[o] + (zh - zl)[o]])
            c = np.concatenate([c[z] << 1, (c[o] << 1) | 1])
            lo, hi = np.concatenate([zl[z], ol[o]]), np.concatenate([zh[z], oh[o]])
        return src, c, self.first[c] + lo - self.start[c], hi - lo, less


class BiIndex:
    """FM-index of ``words`` (distinct) joined by a delimiter (letter 0), extended to either side."""

    LEFT, RIGHT = 0, 1

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        self.lens = np.array([len(p) for p in points], np.int64)
        flat = np.concatenate([*points, np.zeros(0, np.uint32)])
        alphabet, codes = np.unique(flat, return_inverse=True)
        self.symbols = len(alphabet) + 1
        at = np.concatenate([[0], np.cumsum(self.lens + 1)])  # delimiter before each word, and one at the end
        text = np.zeros(int(at[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[at] = False
        text[inside] = codes + 1
        self.text, self.at, self.n = text, at, len(text)
        self.suffixes = suffix_ranks(text, self.symbols)
        self.sides = [Wavelet(text[self.suffixes - 1], self.symbols)]
        back = text[::-1]
        self.sides.append(Wavelet(back[suffix_ranks(back, self.symbols) - 1], self.symbols))

    def half(self, which: np.ndarray, first: bool, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters of the words' first or second halves, from the cut outwards, delimiter last; padded."""
        size = np.where(first, cuts, self.lens[which] - cuts) + 1
        col = np.arange(int(size.max()) if len(size) else 0)
        middle = self.at[which] + 1 + cuts
        place = middle[:, None] + (-1 - col if first else col)
        inside = col < size[:, None]
        return np.where(inside, self.text[np.where(inside, place, 0)], 0), size

    def scheme(self, which: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs: words that equal query word ``which[query]`` in its first (or second)
        half and are one edit away from it in the other half."""
        cuts = self.lens[which] // 2
        same, same_len = self.half(which, first, cuts)
        other, other_len = self.half(which, not first, cuts)
        out = self.LEFT if first else self.RIGHT  # the direction in which the exact half is matched
        q = np.arange(len(which))
        p, o, s = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.n)
        done = []
        for j in range(same.shape[1]):
            end = same_len[q] == j
            done.append((q[end], p[end], o[end], s[end]))
            q, p, o, s = q[~end], p[~end], o[~end], s[~end]
            p, s, less = self.sides[out].step(p, s, same[q, j])
            o = o + less
        done.append((q, p, o, s))
        q, o, p, s = (np.concatenate(x) for x in zip(*done, strict=True))  # turn round: the other side leads
        side = self.sides[1 - out]
        live = s > 0
        exact = q[live], p[live], o[live], s[live]
        wrong = tuple(np.zeros(0, np.int64) for _ in range(4))
        found = []
        for j in range(other.shape[1]):
            q, p, o, s = exact
            c = other[q, j]
            k, x, np_, ns, less = side.letters(p, s)
            letter = x != 0
            k, x, np_, no, ns = k[letter], x[letter], np_[letter], o[k[letter]] + less[letter], ns[letter]
            more = (q[k], np_, no, ns)  # a letter of the found word that the query lacks
            swap = (x != c[k]) & (c[k] != 0)
            lack = c != 0
            later = [tuple(a[swap] for a in more), (q[lack], p[lack], o[lack], s[lack])]
            wq, wp, wo, ws = (np.concatenate([a, b]) for a, b in zip(wrong, more, strict=True))
            c1 = other[wq, j]
            wp, ws, less = side.step(wp, ws, c1)
            wo = wo + less
            hit = (ws > 0) & (c1 == 0)
            found.append((wq[hit], (wo if first else wp)[hit]))
            on = (ws > 0) & (c1 != 0)
            later.append((wq[on], wp[on], wo[on], ws[on]))
            p, s, less = side.step(p, s, c)
            on = (s > 0) & (c != 0)
            exact = q[on], p[on], (o + less)[on], s[on]
            wrong = tuple(np.concatenate(x) for x in zip(*later, strict=True))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, f = (np.concatenate(x) for x in zip(*found, strict=True))
        word = np.searchsorted(self.at, self.suffixes[f])
        pair = np.unique(q * len(self.lens) + word)
        return pair // len(self.lens), pair % len(self.lens)

    def near(self, which: np.ndarray, first: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``scheme`` for any number of words, similar lengths together, as (query word, near word)."""
        which = which[np.argsort(self.lens[which], kind="stable")]
        lo = 0
        while lo < len(which):
            hi = lo + 1
            while hi < len(which) and (hi + 1 - lo) * int(self.lens[which[hi]] + 2) <= CELLS:
                hi = min(len(which), hi + max(1, (hi - lo) // 4))
            q, word = self.scheme(which[lo:hi], first)
            yield which[lo:hi][q], word
            lo = hi


# ---- the distributed search ------------------------------------------------------------------------

def deal(vocabulary: DataFrame, hot_words: int = TASK_WORDS) -> DataFrame:
    """(word, n, key, part, target, query): where every word is found and searched.

    ``key`` stands for (which half, length of the searching word, the half's letters). A word is a
    target of the halves that searching words of its length, one less and one more would share with
    it, and a query for the two halves of its own. The targets of a half that more than
    ``hot_words`` of them share are dealt over parts, and its queries go to all of these."""
    size = F.length("word")

    def halves(d):
        cut = F.floor((size + d) / 2).cast("int")
        return [F.struct(F.lit(kind).alias("kind"), (size + d).alias("size"), half.alias("half"), F.lit(d == 0).alias("query"))
                for kind, half in (("first", F.substring(F.col("word"), F.lit(1), cut)),
                                   ("second", F.substring(F.col("word"), size - (size + d - cut) + 1, size)))]

    at = vocabulary.select("word", "n", F.explode(F.array(*[h for d in (-1, 0, 1) for h in halves(d)])).alias("h"))
    at = at.select("word", "n", F.xxhash64("h.kind", "h.size", "h.half").alias("key"),
                   F.when(F.col("h.query"), F.when(F.col("h.kind") == "first", 1).otherwise(2)).otherwise(0).alias("query"))
    hot = at.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > hot_words).select(
        "key", F.ceil(F.col("words") / hot_words).cast("int").alias("parts"))
    at = at.join(hot, "key", "left")
    parts = F.coalesce("parts", F.lit(1))
    at = at.withColumn("own", F.pmod(F.xxhash64("word"), parts).cast("int"))
    to = F.when((parts > 1) & (F.col("query") > 0), F.sequence(F.lit(0), parts - 1)).otherwise(F.array("own"))
    at = at.withColumn("part", F.explode(to))
    return at.select("word", "n", "key", "part", (F.col("part") == F.col("own")).alias("target"), "query")


def search_task(words: list, n: np.ndarray, key: np.ndarray, part: np.ndarray, target: np.ndarray, query: np.ndarray):
    """Near pairs of the dealt rows of one task as (query row, target row), each exactly once."""
    place: dict[str, int] = {}
    word = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
    names = list(place)
    row_of = np.zeros(len(names), np.int64)
    row_of[word] = np.arange(len(words))
    index = BiIndex(names)
    with np.errstate(over="ignore"):
        route = mix64(key.view(np.uint64) + mix64(part.astype(np.uint64)))
        held = np.sort(mix64(route[target] + mix64(word[target].astype(np.uint64) + np.uint64(1))))
    for kind in (1, 2):
        asked = np.flatnonzero(query == kind)
        row = np.full(len(names), -1)
        for rows in _once(asked, word[asked]):
            row[:] = -1
            row[word[rows]] = rows
            for q, u in index.near(word[rows], kind == 1):
                r = row[q]
                with np.errstate(over="ignore"):
                    code = mix64(route[r] + mix64(u.astype(np.uint64) + np.uint64(1)))
                # a word that is here for another half doesn't count: its own task reports the pair
                ok = held[np.minimum(np.searchsorted(held, code), len(held) - 1)] == code if len(held) else np.zeros(len(r), bool)
                if kind == 2:  # equal in the first half too: the first scheme has it
                    ok &= np.fromiter((not names[b].startswith(names[a][:len(names[a]) // 2]) for a, b in zip(q, u, strict=True)),
                                      bool, len(q))
                yield r[ok], row_of[u[ok]]


def _once(rows: np.ndarray, word: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of ``rows`` in which no word repeats (a hot half's parts may share a task)."""
    while len(rows):
        _, first = np.unique(word, return_index=True)
        yield rows[first]
        rest = np.ones(len(rows), bool)
        rest[first] = False
        rows, word = rows[rest], word[rest]


def near_pairs(vocabulary: DataFrame, tasks: int, hot_words: int = TASK_WORDS) -> DataFrame:
    """(word, n, near, near_n) of all pairs of words (distinct, with two letters at least) one edit apart."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        words, n = t["word"].to_pylist(), t["n"].to_numpy()
        name = np.array(words, object)
        flags = [t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("key", "part", "target", "query")]
        for a, b in search_task(words, n, *flags):
            for lo in range(0, len(a), 20000):
                x, y = a[lo:lo + 20000], b[lo:lo + 20000]
                yield pa.RecordBatch.from_arrays([pa.array(name[x], pa.string()), pa.array(n[x]), pa.array(name[y], pa.string()),
                                                  pa.array(n[y])], ["word", "n", "near", "near_n"])

    dealt = deal(vocabulary, hot_words).repartition(tasks, "key", "part")
    return dealt.mapInArrow(search, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): forms followed to the last by pointer doubling.

    A form occurs at least twice as often as its word, so there is no cycle and the number of
    rounds is the logarithm of the longest chain."""
    cur = shared_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cur.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                      F.col("next").isNotNull().alias("moved"))
        step = shared_table(step, "roots")
        cur = step.select("word", "root")
        if step.where("moved").limit(1).count() == 0:
            return cur


def group_variants(vocabulary: DataFrame, ratio: int = 2, task_words: int = TASK_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocabulary`` (word, n; words distinct,
    of two letters at least).

    A word's form is its near word of largest n (ties: the least in code-point order) if that n is
    at least ``ratio`` (2 or more) times its own. No words give no rows."""
    vocabulary = shared_table(vocabulary.select("word", "n"), "vocabulary")
    tasks = max(1, -(-6 * vocabulary.count() // task_words))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    near = near_pairs(vocabulary, tasks, task_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    words = vocabulary.join(near, "word", "left")
    has = -F.col("best.minus") >= ratio * F.col("n")
    words = words.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.near")).alias("form"),
                         F.when(has, -F.col("best.minus")).alias("form_n"))
    words = shared_table(words, "variants")
    last = roots(words.where("form is not null"))
    return words.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
