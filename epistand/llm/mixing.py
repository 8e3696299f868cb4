"""Mixing documents to target domain weights with soft memberships.

A multinomial logistic classifier on hashed words, fitted on a bounded sample of labelled rows,
gives every document a posterior over domains. Document rates r >= 0 then solve

    minimise  |A r - T|^2 / |T|^2  from r = 1,   A[k, i] = tokens_i * P(domain k | i)

by projected gradient, A r being the expected tokens per domain and T the targets. A document's
rate depends on the data only through the residuals of the steps so far, which are as many numbers
as there are domains, so a step is one pass that sums A r over the posteriors table and no
rate is ever gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import BLOCK_BYTES, Shared, shared_table, text_blocks, word_hashes


def _features(column: pa.Array, width: int):
    """(rows, bucket of each word, row of each word, words per row) for blocks of texts."""
    for lo, hi, data, offsets in text_blocks(column, BLOCK_BYTES // 2):
        h, before = word_hashes(data, offsets)
        n = np.diff(before)
        yield lo, hi, (h % np.uint64(width)).astype(np.int64), np.repeat(np.arange(hi - lo), n), n


def _posteriors(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


class DomainModel:
    """Softmax over mean word weights plus a bias."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def predict(self, bucket: np.ndarray, row: np.ndarray, n: np.ndarray) -> np.ndarray:
        logits = np.tile(self.bias, (len(n), 1))
        for k in range(len(self.domains)):
            logits[:, k] += np.bincount(row, weights=self.weights[bucket, k], minlength=len(n)) / np.sqrt(np.maximum(n, 1))
        return _posteriors(logits)


def train_domains(docs: DataFrame, labels: DataFrame, domain: Column, key: str = "doc_id", text: str = "text",
                  max_labelled: int = 4000, width: int = 1 << 15, rounds: int = 40, ridge: float = 1e-3) -> DomainModel:
    """Fit on at most about ``max_labelled`` labelled documents, chosen by a hash of the key.

    ``domain`` is an expression over ``labels``; NULL domains don't count, and a key with several
    domains has the first by name. Without labelled rows there is one domain, 'all'."""
    marks = labels.select(labels[key].alias("k"), domain.alias("y")).where("y is not null and k is not null")
    marks = marks.groupBy("k").agg(F.min("y").alias("y"))
    rows = docs.select(docs[key].alias("k"), docs[text].alias("text")).join(marks, "k")
    n = marks.count()
    dice = F.pmod(F.xxhash64(F.lit("mixing sample"), F.col("k").cast("string")), F.lit(1_000_000))
    rows = rows.where(dice < min(1.0, max_labelled / max(n, 1)) * 1_000_000)

    def vectors(batches):
        for batch in batches:
            for lo, hi, bucket, row, size in _features(batch["text"], width):
                pair, count = np.unique(row * width + bucket, return_counts=True)
                per = np.bincount(pair // width, minlength=hi - lo)
                at = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                value = count / np.sqrt(np.maximum(size, 1))[pair // width]
                yield pa.RecordBatch.from_arrays(
                    [batch["y"].slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at), pa.array((pair % width).astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(value.astype(np.float32)))], ["y", "b", "v"])

    sample = rows.select("y", "text").mapInArrow(vectors, "y string, b array<int>, v array<float>").toArrow()
    domains = sorted(set(sample["y"].to_pylist()))
    if not domains:
        return DomainModel(["all"], np.zeros((width, 1)), np.zeros(1))
    y = np.array([domains.index(v) for v in sample["y"].to_pylist()])
    b, v = sample["b"].combine_chunks(), sample["v"].combine_chunks()
    row = np.repeat(np.arange(len(y)), np.diff(b.offsets.to_numpy()))
    bucket, value = b.flatten().to_numpy().astype(np.int64), v.flatten().to_numpy().astype(np.float64)
    k = len(domains)
    want = np.eye(k)[y]
    weights, bias = np.zeros((width, k)), np.log(want.mean(0) + 1e-3)
    m, s = np.zeros((width, k)), np.zeros((width, k))
    for step in range(1, rounds + 1):  # Adam on the full sample
        logits = np.stack([np.bincount(row, weights=value * weights[bucket, j], minlength=len(y)) for j in range(k)], 1) + bias
        error = (_posteriors(logits) - want) / len(y)
        grad = np.stack([np.bincount(bucket, weights=value * error[row, j], minlength=width) for j in range(k)], 1) + ridge * weights / len(y)
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
        weights -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
        bias -= 0.5 * error.sum(0)
    return DomainModel(domains, weights.astype(np.float32), bias)


def posteriors(docs: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """``docs`` with ``mix_tokens`` (words of the whole text) and ``mix_posterior`` (by domain)."""
    shared = Shared(docs.sparkSession, model)  # width x domains numbers
    at, width, k = docs.columns.index(text), len(model.weights), len(model.domains)
    if clash := {"mix_tokens", "mix_posterior"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are taken")

    def run(batches):
        for batch in batches:
            for lo, hi, bucket, row, n in _features(batch.column(at), width):
                p = shared.value.predict(bucket, row, n)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo) * k + 1, k, dtype=np.int32)), pa.array(p.ravel()))],
                    [*batch.schema.names, "mix_tokens", "mix_posterior"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, mix_tokens long, mix_posterior array<double>")


def fit_steps(table: DataFrame, target: dict[str, float], domains: list[str], max_steps: int = 40,
              tolerance: float = 1e-4) -> tuple[list[list[float]], dict]:
    """The steps (one number per domain each) that lead from rate 1 to the rates, and a report.

    ``table`` has mix_tokens and mix_posterior. Step s changes a document's rate by the product of
    its posterior with the step, and negative rates become 0. The steps are projected-gradient
    steps with the documents' tokens as metric (a document's gradient is its tokens times that
    product), of the size that is exact while no rate is clipped."""
    k = len(domains)
    at = lambda j: F.get("mix_posterior", F.lit(j))
    first = table.agg(F.coalesce(F.sum("mix_tokens"), F.lit(0)).alias("tokens"),
                      *[F.coalesce(F.sum(F.col("mix_tokens") * at(i) * at(j)), F.lit(0.0)).alias(f"g{i}_{j}")
                        for i in range(k) for j in range(k)]).first()
    tokens = float(first["tokens"])
    share = np.array([max(0.0, float(target.get(d, 0.0))) for d in domains])
    if tokens == 0 or share.sum() == 0:
        return [], {"domains": domains, "tokens": tokens, "before": [0.0] * k, "after": [0.0] * k, "target": [0.0] * k}
    goal = share / share.sum() * tokens
    gram = np.array([[first[f"g{i}_{j}"] for j in range(k)] for i in range(k)])
    # A A' in the tokens metric; its pseudo-inverse scales the residual
    scale = np.linalg.pinv(gram + 1e-9 * np.trace(gram) / k * np.eye(k))
    steps: list[list[float]] = []
    before = None
    for _ in range(max_steps + 1):
        rate = rate_column(steps)
        sums = table.agg(*[F.sum(F.col("mix_tokens") * rate * at(j)).alias(f"a{j}") for j in range(k)]).first()
        got = np.array([sums[f"a{j}"] for j in range(k)])
        before = got if before is None else before
        if np.linalg.norm(got - goal) <= tolerance * np.linalg.norm(goal) or len(steps) == max_steps:
            break
        steps.append((scale @ (goal - got)).tolist())
    return steps, {"domains": domains, "tokens": tokens, "before": before.tolist(), "after": got.tolist(), "target": goal.tolist()}


def rate_column(steps: list[list[float]]) -> Column:
    """Rate of a row with mix_posterior after ``steps``."""
    if not steps:
        return F.lit(1.0)
    table = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    return F.aggregate(table, F.lit(1.0), lambda r, s: F.greatest(
        F.lit(0.0), r + F.aggregate(F.zip_with("mix_posterior", s, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)))


def mix(docs: DataFrame, labels: DataFrame, domain: Column, target: dict[str, float], key: str = "doc_id", text: str = "text",
        seed: int = 0, **options) -> tuple[DataFrame, dict]:
    """(one row per input row: ``doc_id, tokens, posterior, domain, rate, copies``; the report).

    ``posterior`` maps domains to probabilities, ``domain`` is the likeliest (first by name in
    ties), ``rate`` the fitted rate and ``copies`` the whole copies that a sampler takes: the floor
    of the rate and one more with the chance of the rest, drawn by a hash of key and seed. NULL and
    empty texts have no tokens and the classifier's prior; repeated rows have equal rates. A target
    without weight for any learned domain, or a table without tokens, leaves all rates at 1."""
    model = train_domains(docs, labels, domain, key, text, **options)
    named = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    table = shared_table(posteriors(named, model).drop("text"), "posteriors")
    steps, report = fit_steps(table, target, model.domains)
    names = F.array(*map(F.lit, model.domains))
    dice = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    rated = table.withColumn("rate", rate_column(steps))
    rest = F.col("rate") - F.floor("rate")
    return rated.select(
        "doc_id", F.col("mix_tokens").alias("tokens"), F.map_from_arrays(names, "mix_posterior").alias("posterior"),
        F.element_at(names, F.array_position("mix_posterior", F.array_max("mix_posterior")).cast("int")).alias("domain"), "rate",
        (F.floor("rate") + F.when(dice < rest, 1).otherwise(0)).cast("int").alias("copies")), report


def apply_mix(docs: DataFrame, labels: DataFrame, domain: Column, target: dict[str, float], key: str = "doc_id", text: str = "text",
              seed: int = 0, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, possibly not at all."""
    model = train_domains(docs, labels, domain, key, text, **options)
    columns = docs.columns
    table = shared_table(posteriors(docs, model, text), "mixed")
    steps, _ = fit_steps(table.select("mix_tokens", "mix_posterior"), target, model.domains)
    rate = rate_column(steps)
    dice = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`").cast("long")), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor(rate) + F.when(dice < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    taken = table.withColumn("__copies", copies).where("__copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*[F.col(f"`{c}`") for c in columns])
