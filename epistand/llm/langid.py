"""Language identification with interpolated Kneser-Ney character models.

One character n-gram model per language (order 4 by default). A text is folded to lower-case
letters with single spaces; its language is the one with the lowest length-normalised
cross-entropy. A language's n-gram probabilities and back-off weights stand in sorted arrays of
exact 64-bit n-gram codes, merged over the languages so that one binary search serves all.

Training reads a bounded sample of labelled rows: at most about ``docs_per_lang`` whole texts per
language, chosen by a hash of the key (a documented bound; it also bounds the broadcast model).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import Shared, release_memory

BITS = 16  # bits of a symbol in an n-gram code; order 4 fills 64 bits
SPACE, OTHER = 0, 1  # any run of non-letters; a letter that training has not seen
_BLOCK_CHARS = 400_000


def letter_table() -> np.ndarray:
    """True for the code points of letters."""
    t = np.zeros(0x110000, bool)
    for lo, hi in ((0, 0xD800), (0xE000, 0x110000)):
        t[lo:hi] = np.fromiter((chr(c).isalpha() for c in range(lo, hi)), bool, hi - lo)
    return t


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts and their lengths; lone surrogates become '?'."""
    low = [(t or "").lower() for t in texts]
    data = "".join(low).encode("utf-32-le", "replace")
    return np.frombuffer(data, "<u4"), np.array([len(t) for t in low], np.int64)


def text_parts(column: pa.Array, limit: int = _BLOCK_CHARS):
    """Lists of whole texts of about ``limit`` characters, a longer text alone."""
    part, size = [], 0
    for t in column:
        t = t.as_py()
        part.append(t)
        size += len(t or "")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part
    release_memory()


def symbols(cps: np.ndarray, lengths: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the texts (non-letters as SPACE, runs collapsed, none at the start), the text
    number of each symbol and its position in that text."""
    ids = alphabet[cps]
    doc = np.repeat(np.arange(len(lengths)), lengths)
    prev = np.concatenate([[SPACE], ids[:-1]]).astype(ids.dtype)
    first = np.cumsum(lengths) - lengths
    prev[first[lengths > 0]] = SPACE
    keep = (ids != SPACE) | (prev != SPACE)
    ids, doc = ids[keep], doc[keep]
    per = np.bincount(doc, minlength=len(lengths))
    pos = np.arange(len(ids)) - np.repeat(np.cumsum(per) - per, per)
    return ids.astype(np.uint64), doc, pos


def gram_codes(ids: np.ndarray, pos: np.ndarray, order: int) -> np.ndarray:
    """Code of the ``order`` symbols that end at each position, SPACE before a text's start."""
    code = ids.copy()
    for i in range(1, order):
        before = np.zeros_like(ids)
        before[i:] = ids[:-i] if i < len(ids) else ids[:0]
        before[pos < i] = SPACE
        code |= before << np.uint64(BITS * i)
    return code


@dataclass
class LanguageModel:
    langs: list[str]
    order: int
    alphabet: np.ndarray  # code point -> symbol
    grams: list[np.ndarray]  # per order k: sorted codes of k symbols, seen in any language
    logp: list[np.ndarray]  # per order k: ln P of the last symbol given the others, a column per language
    contexts: list[np.ndarray]  # per length k: sorted codes of contexts
    backoff: list[np.ndarray]  # per length k: ln of the weight left to the shorter context
    temperature: float = 1.0
    mean: np.ndarray | None = None  # per language: cross-entropy of its own texts,
    spread: np.ndarray | None = None  # its deviation times the root of the length,
    limit: np.ndarray | None = None  # and the largest accepted deviation in these units

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        """ln P under each language of each full-order code's last symbol."""
        out = np.zeros((len(codes), len(self.langs)), np.float32)
        left, code = np.arange(len(codes)), codes
        for k in range(self.order, 0, -1):
            at = np.searchsorted(self.grams[k], code)
            at[at == len(self.grams[k])] = 0
            hit = self.grams[k][at] == code if len(self.grams[k]) else np.zeros(len(code), bool)
            out[left[hit]] += self.logp[k][at[hit]]
            left, code = left[~hit], code[~hit]
            if not len(left):
                break
            if k > 1:
                context = code >> np.uint64(BITS)
                at = np.searchsorted(self.contexts[k - 1], context)
                at[at == len(self.contexts[k - 1])] = 0
                known = self.contexts[k - 1][at] == context
                out[left[known]] += self.backoff[k - 1][at[known]]
                code = code & np.uint64((1 << (BITS * (k - 1))) - 1)
        return out

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Summed ln P of each text under each language, and the number of symbols."""
        cps, lengths = code_points(texts)
        ids, doc, pos = symbols(cps, lengths, self.alphabet)
        n = np.bincount(doc, minlength=len(lengths))
        sums = np.zeros((len(lengths), len(self.langs)))
        if len(ids):
            logp = self.log_probs(gram_codes(ids, pos, self.order)).astype(np.float64)
            has = np.flatnonzero(n)
            sums[has] = np.add.reduceat(logp, (np.cumsum(n) - n)[has], axis=0)
        return sums, n

    def decide(self, sums: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language (-1 without letters), confidence, its cross-entropy, accepted."""
        some = n > 0
        best = np.where(some, sums.argmax(1), -1)
        z = (sums - sums.max(1, keepdims=True)) / self.temperature
        score = np.where(some, 1 / np.exp(z).sum(1), 0.0)
        entropy = np.where(some, -sums.max(1) / np.maximum(n, 1), 0.0)
        accepted = some.copy()
        if self.limit is not None:
            room = self.limit[best] * self.spread[best] / np.sqrt(np.maximum(n, 1))
            # at least half the way to the entropy of letters dealt evenly: long texts mix topics
            room = np.maximum(room, 0.5 * (np.log(self.alphabet.max() + 2) - self.mean[best]))
            accepted &= entropy <= self.mean[best] + room
        return best, score, entropy, accepted


def kneser_ney(counts: dict[int, int], order: int, vocabulary: int) -> tuple[list[dict], list[dict]]:
    """(ln P by code, ln back-off weight by context code), each by order, from full-order counts.

    Full-order grams count occurrences, lower ones the distinct symbols before them; one absolute
    discount per order (n1 / (n1 + 2 n2)), interpolated down to the uniform distribution."""
    shift, grams = np.uint64(BITS), [None] * (order + 1)
    codes = np.fromiter(counts.keys(), np.uint64, len(counts))
    n = np.fromiter(counts.values(), np.float64, len(counts))
    rank = np.argsort(codes)
    grams[order] = (codes[rank], n[rank])
    for k in range(order - 1, 0, -1):
        grams[k] = tuple(np.unique(grams[k + 1][0] & np.uint64((1 << (BITS * k)) - 1), return_counts=True))
    logp, backoff = [None] * (order + 1), [None] * (order + 1)
    lower = None
    for k in range(1, order + 1):
        code, n = grams[k]
        n = n.astype(np.float64)
        n1, n2 = float((n == 1).sum()), float((n == 2).sum())
        discount = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
        context, inverse = np.unique(code >> shift, return_inverse=True)
        total = np.bincount(inverse, weights=n)
        rest = discount * np.bincount(inverse) / total
        if k == 1:
            base = np.full(len(code), 1.0 / vocabulary)
        else:
            base = lower[1][np.searchsorted(lower[0], code & np.uint64((1 << (BITS * (k - 1))) - 1))]
        p = (n - discount) / total[inverse] + rest[inverse] * base
        lower = (code, p)
        logp[k] = (code, np.log(p))
        backoff[k - 1] = (context, np.log(rest))
    return logp, backoff


def build_model(langs: list[str], alphabet: np.ndarray, counts: list[dict[int, int]], order: int) -> LanguageModel:
    """Merge the languages' models: each gram seen anywhere has its probability in every language."""
    vocabulary = int(alphabet.max()) + 2
    models = [kneser_ney(c, order, vocabulary) if c else None for c in counts]
    empty = np.zeros(0, np.uint64)
    m = LanguageModel(langs, order, alphabet, [empty], [np.zeros((0, len(langs)), np.float32)], [empty], [empty])
    union = lambda parts: np.unique(np.concatenate([empty, *parts]))
    for k in range(1, order + 1):
        context = union([x[1][k - 1][0] for x in models if x]) if k > 1 else np.zeros(1, np.uint64)
        weight = np.zeros((len(context), len(langs)), np.float32)
        for j, x in enumerate(models):
            if x:
                own, w = x[1][k - 1]
                weight[np.searchsorted(context, own), j] = w
        if k > 1:
            m.contexts.append(context)
            m.backoff.append(weight)
        code = union([x[0][k][0] for x in models if x])
        if k == 1:
            code = np.union1d(code, np.arange(vocabulary, dtype=np.uint64))
            logp = weight[[0] * len(code)] - np.log(vocabulary)
        else:
            at = np.searchsorted(context, code >> np.uint64(BITS))
            down = code & np.uint64((1 << (BITS * (k - 1))) - 1)
            logp = weight[at] + m.logp[k - 1][np.searchsorted(m.grams[k - 1], down)]
        for j, x in enumerate(models):
            if x:
                own, p = x[0][k]
                logp[np.searchsorted(code, own), j] = p
        m.grams.append(code)
        m.logp.append(logp.astype(np.float32))
    return m


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", usable: Column | None = None,
          order: int = 4, docs_per_lang: int = 600, max_langs: int = 400, tail: float = 0.999,
          slack: float = 2.0) -> LanguageModel:
    """Fit the models and their calibration on rows with text and label (and ``usable``).

    Every fifth sampled text is left out of the counts and calibrates: the temperature of the
    confidence, and per language the accepted deviation of cross-entropy (its ``tail`` quantile
    times ``slack``, at least 8 deviations, and never less than half the way to the entropy of evenly
    dealt letters). A language with fewer than 20 rightly predicted calibration texts has that half way
    as its whole limit, from the mean of those texts or, without any, of all languages'. More than ``max_langs`` labels are an error. No
    labelled row at all gives a model without languages."""
    rows = docs.select(docs[text].alias("text"), docs[lang].cast("string").alias("lang"),
                       docs[key].cast("string").alias("key"), (F.lit(True) if usable is None else usable).alias("ok"))
    rows = rows.where("ok and lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, docs_per_lang / sizes[k]))]) if langs else None
    if not langs:
        return LanguageModel([], order, np.zeros(0x110000, np.uint16), [], [], [], [])
    dice = F.pmod(F.xxhash64(F.lit("language sample"), "key"), F.lit(1_000_000))
    sample = rows.where(dice < share[F.col("lang")] * 1_000_000)
    fit = F.pmod(F.xxhash64(F.lit("calibration"), "key"), F.lit(5)) != 0
    sample = sample.select("text", "lang", fit.alias("fit")).repartition(8).persist()
    try:
        fitted = sample.where("fit") if not sample.where("fit").isEmpty() else sample
        chars = fitted.select(F.explode(F.split(F.lower("text"), "")).alias("c")).where("c rlike '^\\\\p{L}'").distinct()
        chars = sorted({c for r in chars.collect() for c in r["c"].lower() if c.isalpha()})[: (1 << BITS) - 3]
        alphabet = np.where(letter_table(), OTHER, SPACE).astype(np.uint16)
        for i, c in enumerate(chars):
            alphabet[ord(c)] = i + 2
        number = {x: i for i, x in enumerate(langs)}
        shared = sample.sparkSession.sparkContext.broadcast(alphabet)

        def count(batches):
            for batch in batches:
                names = np.array([number[x] for x in batch["lang"].to_pylist()])
                done = 0
                for part in text_parts(batch["text"]):
                    ids, doc, pos = symbols(*code_points(part), shared.value)
                    codes = gram_codes(ids, pos, order)
                    who = names[done:done + len(part)][doc]
                    done += len(part)
                    for j in np.unique(who):
                        code, n = np.unique(codes[who == j], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), j, np.int32)),
                                                          pa.array(code.view(np.int64)), pa.array(n.astype(np.int64))],
                                                         ["j", "code", "n"])

        grams = (fitted.select("lang", "text").mapInArrow(count, "j int, code long, n long")
                 .groupBy("j", "code").agg(F.sum("n").alias("n")).toPandas())
        counts = []
        for j in range(len(langs)):
            own = grams[grams["j"] == j]
            counts.append(dict(zip(own["code"].to_numpy().view(np.uint64).tolist(), own["n"].tolist(), strict=True)))
        model = build_model(langs, alphabet, counts, order)
        held = sample.where("not fit") if not sample.where("not fit").isEmpty() else sample
        _calibrate(model, held, number, tail, slack)
    finally:
        sample.unpersist()
    return model


def _calibrate(model: LanguageModel, held: DataFrame, number: dict[str, int], tail: float, slack: float) -> None:
    shared = Shared(held.sparkSession, model)
    width = len(model.langs)

    def score(batches):
        for batch in batches:
            names = np.array([number[x] for x in batch["lang"].to_pylist()], np.int32)
            done = 0
            for part in text_parts(batch["text"]):
                sums, n = shared.value.score(part)
                yield pa.RecordBatch.from_arrays([pa.array(names[done:done + len(part)]), pa.array(n.astype(np.int64)),
                                                  pa.array(list(sums), pa.list_(pa.float64()))], ["j", "n", "sums"])
                done += len(part)

    rows = held.select("lang", "text").mapInArrow(score, "j int, n long, sums array<double>").where("n > 0").toPandas()
    if not len(rows):
        return
    sums, n, j = np.stack(rows["sums"].to_numpy()), rows["n"].to_numpy(), rows["j"].to_numpy()
    z = sums - sums.max(1, keepdims=True)
    loss = {t: float(np.mean(np.log(np.exp(z / t).sum(1)) - z[np.arange(len(j)), j] / t)) for t in (1, 2, 4, 8, 16, 32)}
    model.temperature = float(min(loss, key=loss.get))
    model.mean, model.spread, model.limit = np.zeros(width), np.ones(width), np.zeros(width)
    entropy = -sums[np.arange(len(j)), j] / n
    right = sums.argmax(1) == j
    for k in range(width):
        own = right & (j == k)
        if own.sum() < 20:  # too few for a quantile
            some = next(x for x in (own, right, np.ones(len(j), bool)) if x.any())
            model.mean[k] = np.average(entropy[some], weights=n[some])
            continue
        model.mean[k] = np.average(entropy[own], weights=n[own])
        dev = (entropy[own] - model.mean[k]) * np.sqrt(n[own])
        model.spread[k] = max(float(np.sqrt(np.mean(dev ** 2))), 1e-6)
        model.limit[k] = max(8.0, slack * float(np.quantile(dev / model.spread[k], tail)))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", unknown: str = "und") -> DataFrame:
    """``docs`` with ``lang_pred, lang_score, cross_entropy, lang_accepted`` (names must be free).

    Whole texts are scored. NULL, empty and letterless texts get ``unknown``, score 0 and are not
    accepted; equal scores go to the first language by name. lang_score is the calibrated
    probability of the answer; accepted is false where the cross-entropy lies outside what texts
    of that language showed. Without languages in the model everything is ``unknown``."""
    extra = "lang_pred string, lang_score double, cross_entropy double, lang_accepted boolean"
    shared = Shared(docs.sparkSession, model)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            m = shared.value
            pred, score, entropy, ok = [], [], [], []
            for part in text_parts(batch.column(at)):
                if m.langs:
                    best, s, e, a = m.decide(*m.score(part))
                else:
                    best, s, e, a = np.full(len(part), -1), np.zeros(len(part)), np.zeros(len(part)), np.zeros(len(part), bool)
                pred += [m.langs[b] if b >= 0 else unknown for b in best]
                score.append(s)
                entropy.append(e)
                ok.append(a)
            if pred:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pred, pa.string()), pa.array(np.concatenate(score)),
                     pa.array(np.concatenate(entropy)), pa.array(np.concatenate(ok))], [*batch.schema.names, *names])

    names = [x.split()[0] for x in extra.split(", ")]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are taken")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", " + extra
    return docs.mapInArrow(run, schema)
