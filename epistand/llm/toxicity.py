"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding: compatibility characters, diacritics and Cyrillic or Greek look-alikes become Latin
letters, digits and signs used for letters become those letters (1, l, | and ! all become i), and
everything else separates words. Such digits and signs at the edge of a word can be letters (1d10t)
or punctuation (idiot!), so they are marked, and a word is read with any number of them left out on
either side. The lexicon holds words whose presence separates toxic from
other labelled texts, weighted by their log-odds. Exception phrases (a lexicon word with one fixed
neighbour, seen mostly in texts that aren't toxic) cancel the word inside them. A text's score is a
logistic function of its summed weights, their length-normalised sum and its largest weight; a word
counts once, by its heaviest reading, and an exception phrase cancels it in all readings. The lexicon
is learned from the readings with all or none of the edge signs on each side.

Training reads at most about ``max_labelled`` labelled rows, chosen by a hash of the key (a
documented bound of the classifier's sample). The lexicon has at most ``max_terms`` words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import Shared
from epistand.llm.langid import text_parts

# Characters that stand for a Latin letter.
LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i",
    "l": "i", "€": "e", "£": "l",
    "а": "a", "в": "b", "е": "e", "з": "e", "и": "u", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i", "һ": "h",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ł": "i", "ø": "o", "đ": "d", "ı": "i", "ɑ": "a", "ɡ": "g",
}
EDGES = re.compile("^([A-Z]*).*?([A-Z]*)$", re.DOTALL)  # of a folded word
MARKED = re.compile("[A-Z]")
UNMARK = {c: c + 32 for c in range(65, 91)}
INVISIBLE = "­​‌‍⁠﻿"


def fold_table() -> np.ndarray:
    """Code point -> folded code point; 32 separates words, 0 vanishes."""
    t = np.full(0x110000, 32, np.uint32)
    for c in [*range(0xD800), *range(0xE000, 0x20000)]:
        ch = chr(c)
        if ch in INVISIBLE or unicodedata.combining(ch):
            t[c] = 0
            continue
        low = unicodedata.normalize("NFKD", ch).lower()[:1] or ch
        low = low.lower()[:1]
        low = LOOKALIKES.get(low, low)
        if low.isalpha():
            t[c] = ord(low)
    return t


def fold_texts(texts: list[str | None], table: np.ndarray) -> list[str]:
    """Folded texts: words separated and enclosed by single spaces. Signs that stand for letters
    (digits, @, $, ! and |) count as letters only inside a word with at least one letter; those before
    its first or after its last letter are marked as capitals."""
    data = np.frombuffer("\n".join((t or "").replace("\n", " ") for t in texts).encode("utf-32-le", "replace"), "<u4")
    line = data == 10
    out = table[data]
    # a run of look-alike digits and signs alone is no word
    plain = (data < 128) & (((data >= 48) & (data <= 57)) | np.isin(data, [33, 36, 64, 124]))
    real = (out != 32) & (out != 0) & ~plain
    word = out != 32
    run = np.cumsum(~word)
    has = np.zeros(run[-1] + 1 if len(run) else 1, bool)
    has[run[real]] = True
    first, last = np.zeros(len(has), np.int64), np.zeros(len(has), np.int64)
    at = np.flatnonzero(real)
    first[run[at[::-1]]], last[run[at]] = at[::-1], at  # of several the last assigned stays
    place = np.arange(len(out))
    edge = word & plain & has[run] & ((place < first[run]) | (place > last[run]))
    out = np.where(edge, out - 32, out)
    out = np.where(word & has[run], out, 32)
    out = np.where(out == 0, 0, out)
    out[line] = 10
    space = (out == 32)
    out = out[(out != 0) & ~(space & np.concatenate([[True], space[:-1]]))]
    return [f" {x.strip()} " for x in out.astype("<u4").tobytes().decode("utf-32-le").split("\n")]


def readings(word: str) -> set[str]:
    """The word with all or none of its edge signs on each side."""
    if not MARKED.search(word):
        return {word}
    lead, trail = (len(x) for x in EDGES.match(word).groups())
    word = word.translate(UNMARK)
    return {word[a:len(word) - b] for a in (0, lead) for b in (0, trail)}


@dataclass
class ToxicityModel:
    terms: dict[str, float]  # folded word -> weight
    exceptions: set[str] = field(default_factory=set)  # "word word": cancels the lexicon word in it
    coefficients: np.ndarray | None = None  # intercept, sum, normalised sum, largest
    _automata: object = None

    def automata(self):
        """Two automata of the lexicon and the words of exception phrases: between spaces, and bare."""
        if self._automata is None:
            self._automata = ahocorasick.Automaton(), ahocorasick.Automaton()
            for w in {*self.terms, *(w for e in self.exceptions for w in e.split())}:
                self._automata[0].add_word(f" {w} ", w)
                self._automata[1].add_word(w, w)
            for x in self._automata:
                if len(x):
                    x.make_automaton()
        return self._automata

    def __getstate__(self):
        return {**self.__dict__, "_automata": None}

    def matches(self, folded: str, words: list[str]) -> dict[int, set[str]]:
        """Word number -> its readings that the automata hold."""
        spaced, bare = self.automata()
        hits: dict[int, set[str]] = {}
        if not len(spaced):
            return hits
        number, at = -1, 0
        for end, w in spaced.iter(folded):
            start = end - len(w)  # of the word after its space
            number, at = number + folded.count(" ", at, start), start
            hits.setdefault(number, set()).add(w)
        if MARKED.search(folded):
            for i, word in enumerate(words):
                if MARKED.search(word):
                    lead, trail = (len(x) for x in EDGES.match(word).groups())
                    for end, w in bare.iter(word.translate(UNMARK)):
                        if end + 1 - len(w) <= lead and end + 1 >= len(word) - trail:
                            hits.setdefault(i, set()).add(w)
        return hits

    def features(self, folded: str) -> tuple[float, float, float]:
        words = folded.split()
        hits = self.matches(folded, words)
        cancelled = {k for i in hits for k in (i, i + 1)
                     if any(f"{a} {b}" in self.exceptions for a in hits[i] for b in hits.get(i + 1, ()))}
        found = [max(self.terms.get(w, 0.0) for w in x) for i, x in hits.items() if i not in cancelled]
        total = float(sum(found))
        return total, total / math.sqrt(max(len(words), 1)), max([0.0, *found])

    def score(self, features: np.ndarray) -> np.ndarray:
        c = self.coefficients
        return 1 / (1 + np.exp(-np.clip(c[0] + squashed(features) @ c[1:], -50, 50)))


def squashed(features: np.ndarray) -> np.ndarray:
    return np.log1p(np.asarray(features, float))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps, slopes kept nonnegative; intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        penalty = np.r_[1e-3, np.full(len(w) - 1, ridge)]
        grad = x.T @ (weight * (p - y)) + penalty * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w = w - np.linalg.solve(hess, grad)
        w[1:] = np.maximum(w[1:], 0)
    return w


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
          usable: Column | None = None, max_labelled: int = 60_000, max_terms: int = 2000, min_docs: int = 8,
          min_z: float = 4.0, exceptions: tuple[str, ...] = ()) -> ToxicityModel:
    """Learn lexicon, exception phrases and calibration from labelled rows (0 or 1; others are
    ignored; a key labelled twice is toxic if any label is). ``exceptions`` adds phrases of two
    words. Without rows of both classes the model scores every text 0."""
    marks = (labels.select(labels[key].alias("k"), labels[label].cast("int").alias("y")).where("y in (0, 1)")
             .groupBy("k").agg(F.max("y").alias("y")))
    n = marks.count()
    dice = F.pmod(F.xxhash64(F.lit("toxicity sample"), F.col("k").cast("string")), F.lit(1_000_000))
    marks = marks.where(dice < min(1.0, max_labelled / max(n, 1)) * 1_000_000)
    rows = docs.select(docs[key].alias("k"), docs[text].alias("text"), (F.lit(True) if usable is None else usable).alias("ok"))
    # copies of one text are one observation; the labels are a sample of about max_labelled rows of 20
    # bytes at most, so they go to the texts, which stay where they lie
    rows = (rows.where("ok and text is not null").join(F.broadcast(marks), "k").groupBy("text").agg(F.max("y").alias("y"))
            .select("text", "y").persist())
    sc = docs.sparkSession.sparkContext
    table = sc.broadcast(fold_table())
    try:
        sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(sizes) < 2:
            return ToxicityModel({}, set(), np.array([-50.0, 0, 0, 0]))
        model = ToxicityModel({})
        counted = _counts(rows, table, None).where(f"tox >= {min_docs}")
        bad, good = sizes[1], sizes[0]
        odds = (F.log((F.col("tox") + 0.5) / (bad - F.col("tox") + 0.5))
                - F.log((F.col("n") - F.col("tox") + 0.5) / (good - F.col("n") + F.col("tox") + 0.5)))
        spread = F.sqrt(1 / (F.col("tox") + 0.5) + 1 / (F.col("n") - F.col("tox") + 0.5))
        # seven in ten of the texts that hold the word are toxic, and not by chance
        best = (counted.select("gram", odds.alias("w"), (odds / spread).alias("z"), "tox", "n")
                .where((F.col("z") >= min_z) & (F.col("tox") * 10 >= F.col("n") * 7))
                .orderBy(F.desc("z"), "gram").limit(max_terms).collect())
        model.terms = {r["gram"]: float(r["w"]) for r in best}
        rate = {r["gram"]: r["tox"] / r["n"] for r in best}
        phrases = _counts(rows, table, set(model.terms)).where("n >= 8").collect() if best else []
        model.exceptions = {" ".join(fold_texts([e], table.value)[0].translate(UNMARK).split()) for e in exceptions}
        for r in phrases:
            word = max((rate.get(w, 0) for w in r["gram"].split()))
            if r["tox"] / r["n"] < 0.1 * word:
                model.exceptions.add(r["gram"])
        x, y = _feature_rows(rows, table, model)
        model.coefficients = _logistic(squashed(x), y, np.ones(len(y)))
    finally:
        rows.unpersist()
    return model


def _counts(rows: DataFrame, table, terms: set[str] | None) -> DataFrame:
    """(gram, texts, toxic texts): readings of words, or pairs of them that hold one of ``terms``."""

    def count(batches):
        n, tox = Counter(), Counter()
        for batch in batches:
            y, done = batch["y"].to_pylist(), 0
            for part in text_parts(batch["text"]):
                for t in fold_texts(part, table.value):
                    words = [readings(w) for w in t.split()]
                    grams = set().union(*words) if terms is None else {
                        f"{a} {b}" for x, y in zip(words, words[1:], strict=False) for a in x for b in y if a in terms or b in terms}
                    n.update(grams)
                    if y[done]:
                        tox.update(grams)
                    done += 1
            if len(n) > 300_000:
                yield _record(n, tox)
                n, tox = Counter(), Counter()
        yield _record(n, tox)

    def _record(n, tox):
        grams = list(n)
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array([n[g] for g in grams], pa.int64()),
                                           pa.array([tox[g] for g in grams], pa.int64())], ["gram", "n", "tox"])

    return (rows.select("text", "y").mapInArrow(count, "gram string, n long, tox long")
            .groupBy("gram").agg(F.sum("n").alias("n"), F.sum("tox").alias("tox")))


def _feature_rows(rows: DataFrame, table, model: ToxicityModel) -> tuple[np.ndarray, np.ndarray]:
    shared = Shared(rows.sparkSession, model)

    def run(batches):
        for batch in batches:
            f = [shared.value.features(t) for part in text_parts(batch["text"]) for t in fold_texts(part, table.value)]
            if f:
                a, b, c = (pa.array(x, pa.float64()) for x in zip(*f, strict=True))
                yield pa.RecordBatch.from_arrays([a, b, c, batch["y"]], ["a", "b", "c", "y"])

    out = rows.select("text", "y").mapInArrow(run, "a double, b double, c double, y int").toPandas()
    return out[["a", "b", "c"]].to_numpy(), out["y"].to_numpy()


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_predicted`` (1 at ``threshold`` or more).

    Whole texts are scored; NULL counts as empty and scores as a text without lexicon words. Names
    of the new columns must be free."""
    sc = docs.sparkSession.sparkContext
    shared, table = Shared(docs.sparkSession, model), sc.broadcast(fold_table())
    at = docs.columns.index(text)
    if clash := {"toxicity", "toxic_predicted"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are taken")

    def run(batches):
        for batch in batches:
            m = shared.value
            f = [m.features(t) for part in text_parts(batch.column(at)) for t in fold_texts(part, table.value)]
            if f:
                s = m.score(np.array(f))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    [*batch.schema.names, "toxicity", "toxic_predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, schema + ", toxicity double, toxic_predicted int")
