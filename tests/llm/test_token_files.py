"""Token files: Elias-Fano codes, exact ids against the tokenizers library, offsets and checksums."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from epistand.llm import token_files
from epistand.llm.token_files import EliasFano, PieceTokenizer, Segment

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Hello  world, it's  me", "", "   ", "\n\n a\n  b ", "a<|endoftext|> b", "né le　 x   y", "汉字 汉字 字", "x" * 5000,
         "tab\t x  \x1c y", "é", " lead", "trail ", "😀 😀 ok", "1 22 333 don't we'll", "a\r\n b\u0085 c\u0085  d"]


def brute(rows):
    """doc_id -> multiset of (start, n, crc) in ascending doc_id order (null first)."""
    tok = Tokenizer.from_file(PATH)
    out, at = [], 0
    for key, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 2, 1 << 62], list(range(0, 90000, 7)), [2 ** 64 - 1]])
def test_elias_fano(values):
    ef = EliasFano(EliasFano.encode(np.array(values, np.uint64)))
    assert [ef.select(i) for i in range(0, len(values), max(1, len(values) // 50))] == values[::max(1, len(values) // 50)]
    assert ef.select_many(0, len(values)).tolist() == values
    for lo in range(0, len(values), max(1, len(values) // 9)):
        assert ef.select_many(lo, min(lo + 700, len(values))).tolist() == values[lo:lo + 700]
    for v in values[:40]:
        assert ef.find(v) == values.index(v)


def test_elias_fano_space():
    rng = np.random.default_rng(3)
    ends = np.cumsum(rng.integers(1, 900, 20000))
    assert len(EliasFano.encode(ends)) * 8 / len(ends) < 2.3 + np.log2(ends[-1] / len(ends))


def test_pieces_give_the_librarys_ids():
    rng = random.Random(1)
    parts = [*"ab é  \n\t", "  ", " the", "'s", "ing", "字", "😀", "12", "<|endoftext|>", " ", "."]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    tok = Tokenizer.from_file(PATH)
    coder = PieceTokenizer(PATH, max_pieces=500)
    for lo in range(0, len(texts), 300):
        raw = [t.encode() for t in texts[lo:lo + 300]]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        ids, counts = coder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets, 2)
        want = [tok.encode(t, add_special_tokens=False).ids + [2] for t in texts[lo:lo + 300]]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_roundtrip_matches_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE_BYTES", 2000)
    monkeypatch.setattr(token_files, "FAN", 2)
    rng = random.Random(2)
    keys = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(40)] + [1 << 62, -(1 << 63), (1 << 63) - 1]
    rows = [(k, " ".join(rng.choice(TEXTS) for _ in range(rng.randint(0, 8)))) for k in keys]
    rows += [(7, None), (8, TEXTS[0] * 400)]
    df = spark.createDataFrame([(t, k, 1, "x") for k, t in rows], "text string, doc_id long, part int, rid string")
    got = token_files.roundtrip(df, str(tmp_path / "t"), PATH).collect()
    assert len({r.part for r in got}) > 2
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == brute(sorted(rows, key=lambda r: r[0]))


def test_ties_nulls_and_repeats(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE_BYTES", 500)
    rows = [(5, "same text here")] * 60 + [(5, "other")] * 3 + [(None, "no key"), (None, None), (9, "last")]
    got = token_files.roundtrip(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "t"), PATH).collect()
    assert len(got) == len(rows) and len({r.part for r in got if r.doc_id == 5}) > 1  # a hot key spreads over ranges
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None] + [5] * 63 + [9]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    assert sorted(r.ids_crc32 for r in got) == sorted(b[3] for b in brute(rows))


def test_empty_table_and_lookup(spark, tmp_path):
    assert token_files.roundtrip(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"), PATH).count() == 0
    ids = np.array([4, 2, 2, 7, 8, 2], np.uint16)
    s = Segment(Segment.encode(0, 0, ids, np.array([2, 1, 3]), 1, np.array([-5, 12])))
    assert [s.key(i) for i in range(3)] == [None, -5, 12] and s.span(2) == (3, 6)
    assert s.find(12) == 2 and s.find(-5) == 1 and s.find(3) is None and s.find(-9) is None
