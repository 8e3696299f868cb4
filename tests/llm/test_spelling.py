"""Spelling variants against plain Python: counts with planted variants, near words, forms, roots."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from epistand.llm import spelling


def plain_counts(rows, letters=5, least=3):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    minus = {}
    for w in counts:
        for i in range(len(w)):
            minus.setdefault(w[:i] + w[i + 1:], set()).add(w)
    near = {w: set() for w in counts}
    for short, group in minus.items():
        for a in group:
            near[a] |= {b for b in group if is_near(a, b)}
            if short in counts:
                near[a].add(short)
                near[short].add(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def rows_of(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def made_texts():
    rng = random.Random(6)
    words = ["".join(rng.choice("abéÿ") for _ in range(rng.randint(4, 8))) for _ in range(150)] + ["Xylophones", "MÜLLER", "à" * 90, "q" * 400]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "1", "×", "s"]) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    return rows + [(None, "Xylophones xylophones zzzzz zzzzz ZZZZZ"), (900, None), (901, ""), (901, "Müller"), (901, "Müller"),
                   (902, "łaaaaał aaaaa aaaaa aaaaa 字 aaaaa字aaaab aaaab aaaab")]


def test_crcs_of_runs():
    rng = random.Random(3)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 7, 63, 64, 65, 300]))) for _ in range(200)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    lens = np.array([len(p) for p in parts])
    seeds = np.array([zlib.crc32(str(i).encode()) for i in range(len(parts))], np.uint32)
    got = spelling.run_crcs(data, np.cumsum(lens) - lens, lens, seeds)
    assert got.tolist() == [zlib.crc32(str(i).encode() + p) for i, p in enumerate(parts)]


def test_index_extends_both_sides():
    index = spelling.BiIndex(["banana", "bandana", "ananas", "na"])
    text = "".join("$" if c == 0 else chr(96 + c) for c in index.text)
    assert sorted(index.suffixes.tolist(), key=lambda i: text[i:]) == index.suffixes.tolist()
    rng = random.Random(2)
    for _ in range(300):
        at = rng.randrange(len(text))
        lo, hi, f, r, size = at, at, 0, 0, len(text)
        while size and hi - lo < 6:
            if rng.random() < 0.5 and lo > 0:
                lo -= 1
                a, s, less = index.sides[0].step(*(np.array([x]) for x in (f, size, index.text[lo])))
                f, size, r = int(a[0]), int(s[0]), r + int(less[0])
            elif hi < len(text):
                a, s, less = index.sides[1].step(*(np.array([x]) for x in (r, size, index.text[hi])))
                r, size, f = int(a[0]), int(s[0]), f + int(less[0])
                hi += 1
            part = index.text[lo:hi]
            want = [i for i in range(len(text)) if np.array_equal(index.text[i:i + len(part)], part)]
            assert sorted(index.suffixes[f:f + size].tolist()) == want


def test_matches_plain_python(spark):
    rows = made_texts()
    df = spark.createDataFrame([(t, "x", k) for k, t in rows], "text string, word string, doc_id long")
    counts = plain_counts(rows)
    assert {r.word: r.n for r in spelling.count_words(df).collect()} == counts and len(counts) > 100
    assert rows_of(spelling.group_variants(spelling.count_words(df))) == plain_variants(counts)


@pytest.mark.parametrize("hot", [7, 40])
def test_hot_halves_are_dealt_over_parts(spark, hot):
    rng = random.Random(hot)
    words = {"prefix" + "".join(rng.choice("abc") for _ in range(rng.choice([5, 6, 6, 7]))): rng.randint(3, 99) for _ in range(400)}
    words |= {"".join(rng.choice("xy") for _ in range(5)): rng.randint(3, 99) for _ in range(30)}
    got = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"), task_words=hot)
    assert rows_of(got) == plain_variants(words)


def test_chain_and_ties(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 47, "zzzzz": 3, "zzzzy": 6, "zzzzx": 6, "lonely": 5}
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["aaaaa"].root == "aabbb" and got["aabbb"].form is None  # 47 is less than twice 24
    assert got["zzzzz"].form == "zzzzx" and (got["lonely"].n_near, got["lonely"].form, got["lonely"].root) == (0, None, "lonely")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(spelling.count_words(df)).count() == 0
