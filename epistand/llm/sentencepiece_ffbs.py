"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

The piece lattice of a text falls apart at every place that no piece spans (before a run of spaces
and around characters that only byte pieces cover), so it is handled as units. Per block of whole
texts the distinct units' lattices are built once: all substrings are looked up in the sorted
piece hashes, a forward pass sums the weight of all segmentations up to each place, and every
occurrence then draws its pieces from the end backwards. The random numbers are a hash of row
key, unit number and step, so a row has the same segmentation wherever it is computed.

Pieces weigh 1 / (rank + 10) to the power ``sharpness``: a BPE vocabulary has merge ranks instead
of probabilities, and piece frequency falls about as their inverse.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import _BASE, _M2, Shared, mix64, _powers
from epistand.llm.langid import text_parts

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = 0x2581  # stands for a space inside pieces
_BLOCK = 60_000  # characters whose lattices are in memory at a time; a longer text forms a block alone
_SLOT_BITS = 20


@dataclass
class Pieces:
    slots: np.ndarray  # leading bits of a hash -> number of a piece plus 1, or 0
    hashes: np.ndarray  # sorted hashes of the ordinary pieces' code points (spaces as such)
    ids: np.ndarray
    logw: np.ndarray  # of each piece, then of a character spelled in bytes
    lengths: np.ndarray  # in characters, likewise
    longest: int
    joined: np.ndarray  # code point -> some piece of several characters holds it
    byte_ids: np.ndarray  # byte -> piece id
    out: np.ndarray  # bytes of all pieces, by id
    out_at: np.ndarray

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces', and the numbers of these pieces.

        A slot names the first of its pieces in hash order; the few others follow it there."""
        at = np.flatnonzero(self.slots[(h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)])
        j = self.slots[(h[at] >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)] - 1
        while True:
            below = np.flatnonzero((self.hashes[j] < h[at]) & (j + 1 < len(self.hashes)))
            if not len(below):
                break
            j[below] += 1
        hit = self.hashes[j] == h[at]
        return at[hit], j[hit]


def load_pieces(model_file: str = DEFAULT_MODEL, sharpness: float = 1.0) -> Pieces:
    """Vocabulary of a SentencePiece model with byte fallback (the public file at ``model_file``)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    byte_ids, out, words, ids = np.zeros(256, np.int32), [], [], []
    for i in range(n):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[1:-1], 16)] = i
            out.append(bytes([int(p[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(b"")
        else:
            words.append(p.replace("▁", " "))
            ids.append(i)
            out.append(words[-1].encode())
    if any(" " in w.lstrip(" ") for w in words):
        raise ValueError("a piece has a space after another character")
    lengths = np.array([len(w) for w in words])
    cps = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    ends = np.cumsum(lengths)
    h = span_hash(prefix_sums(cps), ends - lengths, lengths)
    joined = np.zeros(0x110000, bool)
    joined[cps[np.repeat(lengths > 1, lengths)]] = True
    order = np.argsort(h)
    slots = np.zeros(1 << _SLOT_BITS, np.int32)
    slot, first = np.unique(h[order] >> np.uint64(64 - _SLOT_BITS), return_index=True)
    slots[slot.astype(np.int64)] = first + 1
    rank = np.arange(len(words))
    logw = -sharpness * np.log(rank + 10.0)
    if len(words) >= 1 << 16:
        raise ValueError("more than 65535 pieces")
    spelled = -2 * sharpness * np.log(len(words) + 10.0)
    return Pieces(slots, h[order], np.array(ids, np.int32)[order], np.append(logw[order], spelled),
                  np.append(lengths[order], 1), int(lengths.max()), joined, byte_ids, np.frombuffer(b"".join(out), np.uint8),
                  np.concatenate([[0], np.cumsum([len(x) for x in out])]))


def prefix_sums(cps: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(cps))
    sums = np.zeros(len(cps) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * up[:len(cps)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Hash of the code points start .. start + length - 1."""
    _, down = _powers(len(sums))
    with np.errstate(over="ignore"):
        return mix64((sums[start + length] - sums[start]) * down[start] + np.asarray(length, np.uint64) * _M2)


def _lattice(cps: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pieces: Pieces):
    """Edges of the units laid end to end. Nodes are numbered so that unit k has lengths[k] + 1.

    Returns each unit's first node, each node's first edge, and of the edges in the order of their
    end node: cumulated probability within the node and the piece number. The number after the
    last piece stands for the bytes of one character."""
    total = int(lengths.sum())
    unit = np.repeat(np.arange(len(lengths)), lengths)
    inner = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    flat = cps[starts[unit] + inner]
    left = lengths[unit] - inner  # characters to the unit's end
    sums = prefix_sums(flat)
    node = np.arange(total) + unit  # node before each character
    uncovered = np.ones(total, bool)
    parts = []
    at = np.arange(total)
    for n in range(1, pieces.longest + 1):
        at = at[left[at] >= n]
        if not len(at):
            break
        hit, j = pieces.find(span_hash(sums, at, n))
        found = at[hit]
        if n == 1:
            uncovered[found] = False
        parts.append(((node[found] + n) << 16) + j)
    parts.append(((node[uncovered] + 1) << 16) + len(pieces.ids))
    key = np.sort(np.concatenate(parts))
    dst, piece = key >> 16, (key & 0xFFFF).astype(np.uint16)
    src = dst - pieces.lengths[piece]
    logw = pieces.logw[piece]
    start = np.empty(len(dst), bool)  # first edge of its end node
    if len(dst):
        start[0] = True
        np.not_equal(dst[1:], dst[:-1], out=start[1:])
    first = np.flatnonzero(start)
    edge_at = np.zeros(total + len(lengths), np.int64)
    edge_at[dst[first]] = first
    # every node but the units' first ones has edges: group g ends at the node after character g
    size = np.diff(np.append(first, len(dst)))
    deepest = int(lengths.max(initial=0))
    small = np.uint16 if deepest < 65536 else np.int64
    by_depth = np.argsort(np.repeat(inner.astype(small), size), kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(inner, weights=size, minlength=deepest))]).astype(np.int64)
    alpha = np.zeros(total + len(lengths))
    weight = np.empty(len(dst))  # share of each edge among those that end with it
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        e = by_depth[a:b]
        value = alpha[src[e]] + logw[e]
        group = np.flatnonzero(start[e])
        run = np.cumsum(start[e]) - 1
        top = np.maximum.reduceat(value, group)
        x = np.exp(value - top[run])
        s = np.add.reduceat(x, group)
        alpha[dst[e[group]]] = top + np.log(s)
        weight[e] = x / s[run]
    cum = np.cumsum(weight)
    cum -= np.repeat(cum[first] - weight[first], size)
    cum[first + size - 1] = 1.0
    return np.cumsum(lengths + 1) - (lengths + 1), edge_at, cum, piece


def encode_block(texts: list[str | None], keys: np.ndarray, pieces: Pieces, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts and the number of ids of each text.

    ``keys`` seeds each row. NULL and empty texts have no ids. A text is prefixed with one space,
    as the vocabulary expects; a literal U+2581 becomes bytes, so nothing is ambiguous."""
    body = [f" {t}" if t else "" for t in texts]
    cps = np.frombuffer("".join(body).encode("utf-32-le"), "<u4")
    size = np.array([len(t) for t in body], np.int64)
    if not len(cps):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    cps = cps.copy()
    text_at = np.cumsum(size) - size
    alone = ~pieces.joined[cps]
    space = cps == 32
    head = np.zeros(len(cps), bool)
    head[text_at[size > 0]] = True
    head |= alone | (space & np.concatenate([[True], ~space[:-1]])) | np.concatenate([[True], alone[:-1]])
    start = np.flatnonzero(head)
    length = np.diff(np.append(start, len(cps)))
    doc = np.searchsorted(text_at[size > 0], start, side="right") - 1
    doc = np.flatnonzero(size > 0)[doc]
    h = span_hash(prefix_sums(cps), start, length)
    _, where, which = np.unique(h, return_index=True, return_inverse=True)
    base, edge_at, cum, piece = _lattice(cps, start[where], length[where], pieces)
    first = base[which]
    cur = first + length
    per = np.bincount(doc, minlength=len(texts))
    ordinal = np.arange(len(start)) - (np.cumsum(per) - per)[doc]
    with np.errstate(over="ignore"):
        state = mix64(mix64(keys.astype(np.int64).view(np.uint64)[doc] + np.uint64(seed) * _BASE) + ordinal.astype(np.uint64) * _M2)
    occ, node, stop = np.arange(len(start)), cur, first
    drawn = []
    step = 0
    while len(occ):
        with np.errstate(over="ignore"):
            u = (mix64(state + np.uint64(step) * _BASE) >> np.uint64(40)).astype(np.float64) / (1 << 24)
        e = edge_at[node]
        later = np.flatnonzero(cum[e] <= u)  # a node's last edge has 1
        while len(later):
            e[later] += 1
            later = later[cum[e[later]] <= u[later]]
        p = piece[e]
        drawn.append((occ, p, node))
        node = node - pieces.lengths[p]
        more = node != stop
        occ, node, stop, state = occ[more], node[more], stop[more], state[more]
        step += 1
    steps = np.zeros(len(start), np.int64)
    for occ, _, _ in drawn:
        steps[occ] += 1
    end = np.cumsum(steps)
    drawn_piece, place = np.empty(end[-1], np.uint16), np.empty(end[-1], np.int64)
    for k, (occ, p, node) in enumerate(drawn):
        at = end[occ] - 1 - k
        drawn_piece[at] = p
        raw = p == len(pieces.ids)
        place[at[raw]] = start[occ[raw]] + node[raw] - first[occ[raw]] - 1
    per_text = np.bincount(doc, weights=steps, minlength=len(texts)).astype(np.int64)
    raw = np.flatnonzero(drawn_piece == len(pieces.ids))
    ids = np.append(pieces.ids, np.int32(-1))[drawn_piece]
    if not len(raw):
        return ids, per_text
    # spell out the characters that no piece covers
    spelled = [chr(c).encode() for c in cps[place[raw]].tolist()]
    width = np.ones(len(ids), np.int64)
    width[raw] = [len(x) for x in spelled]
    text_of = np.repeat(np.arange(len(texts)), per_text)
    count = np.bincount(text_of, weights=width, minlength=len(texts)).astype(np.int64)
    out = np.repeat(ids, width)
    out[out < 0] = pieces.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
    return out, count


def decode_block(ids: np.ndarray, count: np.ndarray, pieces: Pieces) -> list[bytes]:
    """UTF-8 texts of the rows' ids: pieces' bytes end to end, without the leading space."""
    at, n = pieces.out_at[ids], pieces.out_at[ids + 1] - pieces.out_at[ids]
    end = np.cumsum(n)
    data = pieces.out[np.repeat(at - (end - n), n) + np.arange(end[-1] if len(end) else 0)].tobytes()
    edge = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(count)])]
    return [data[a + 1:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model_file: str = DEFAULT_MODEL,
           sharpness: float = 1.0, seed: int = 0) -> DataFrame:
    """``docs`` without ``text``, with ``piece_ids`` (array of int), ``n_pieces`` and ``lossless``
    (the ids decode to exactly the text; names must be free).

    NULL counts as empty; empty texts have no pieces. Rows with the same key and text have the
    same segmentation; a NULL key seeds as 0. Whole texts are encoded, whatever their length."""
    names = [c for c in docs.columns if c != text]
    if clash := {"piece_ids", "n_pieces", "lossless"} & set(names):
        raise ValueError(f"columns {sorted(clash)} are taken")
    pieces = Shared(docs.sparkSession, load_pieces(model_file, sharpness))  # a fixed 32k vocabulary
    at, n_at = docs.columns.index(text), len(docs.columns)

    def run(batches):
        p = pieces.value
        for batch in batches:
            keep = [batch.column(i) for i in range(n_at) if i != at]
            seeds, done = batch.column(n_at).to_numpy(zero_copy_only=False), 0
            for part in text_parts(batch.column(at), _BLOCK):
                ids, count = encode_block(part, seeds[done:done + len(part)], p, seed)
                back = decode_block(ids, count, p)
                same = [b == (t or "").encode() for b, t in zip(back, part, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(done, len(part)) for c in keep], lists, pa.array(count.astype(np.int64)), pa.array(same, pa.bool_())],
                    [*names, "piece_ids", "n_pieces", "lossless"])
                done += len(part)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != text)
    seeded = docs.withColumn("__seed", F.coalesce(docs[key].cast("long"), F.lit(0).cast("long")))
    return seeded.mapInArrow(run, schema + "piece_ids array<int>, n_pieces long, lossless boolean")


def decode(encoded: DataFrame, text: str = "text", model_file: str = DEFAULT_MODEL) -> DataFrame:
    """``encoded`` with the column ``text`` decoded from ``piece_ids`` (NULL ids give '')."""
    if text in encoded.columns:
        raise ValueError(f"column {text} is taken")
    pieces = Shared(encoded.sparkSession, load_pieces(model_file))
    at = encoded.columns.index("piece_ids")

    def run(batches):
        for batch in batches:
            col = batch.column(at).fill_null([])
            count = np.diff(col.offsets.to_numpy())
            back = decode_block(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), count, pieces.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([b.decode() for b in back], pa.string())],
                                             [*batch.schema.names, text])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, `{text}` string")
