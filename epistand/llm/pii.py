"""Personal data by weak supervision.

Candidates are the strict spans (the base rules below, which always stay) and looser ones: spelled
or full-width e-mail addresses, phone numbers without country code, IPv6 addresses, and card-like
digit groups that fail Luhn. Labelers vote yes, no or nothing on every candidate: its format, a
gazetteer (top-level domains, card issuers, reserved networks, area codes), the words around it,
its neighbours, and how repetitive it is. Expectation-maximisation over the counts of all vote
patterns estimates each labeler's reliability per kind, and a logistic span classifier trained on
its posteriors decides which loose candidates are added.

The pattern table has at most kinds x 2 x 3^labelers = 1944 rows whatever the input, so it is the
only thing that reaches the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.llm.common import shared_table

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["format", "gazetteer", "context", "neighbours", "variety"]
YES, NO, NONE = 1, 2, 0

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive forms of the base patterns: same leftmost matches, no retries inside a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = re.compile(r"＠|[(\[{] ?at ?[)\]}]| at (?=[A-Za-z0-9-]+ dot )", re.IGNORECASE)
_SPELLED = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[{] ?dot ?[)\]}]| dot ) ?[A-Za-z0-9-]+)+", re.IGNORECASE)
_LOCAL_PHONE = re.compile(r"(?<![0-9.+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+])00[1-9][0-9 ().-]{7,18}[0-9](?![0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.])")

# Gazetteers and context words (parameters by nature; short fixed lists).
TLDS = frozenset("com org net edu gov int io info biz dev app uk de fr es it nl be ch at se no dk fi pl pt ie eu us ca au nz jp cn in br mx ru".split())
CONTEXT = {
    "email": frozenset("email e-mail mail contact write reply address courriel correo".split()),
    "ip": frozenset("ip host server address node ping client login adresse".split()),
    "card": frozenset("card visa mastercard amex credit debit payment carte karte tarjeta pay".split()),
    "phone": frozenset("phone call tel telephone mobile cell fax contact telefon appel llame ring".split()),
}
AGAINST = frozenset("version isbn issn id order invoice ticket section serial no nr number token key hash".split())
_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base rules, leftmost and non-overlapping within a kind."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:  # a local part holds no @, so each @ has one possible span
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            lo = at
            while lo > free and text[lo - 1] in _LOCAL_CHARS:
                lo -= 1
            if lo < at:
                out.append((0, lo, domain.end()))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Further candidates that overlap neither a strict span nor an earlier loose one."""
    found = []
    for m in _AT.finditer(text):
        lo = m.start() - (m.start() > 0 and text[m.start() - 1] == " ")
        end = lo
        while lo > 0 and text[lo - 1] in _LOCAL_CHARS:
            lo -= 1
        tail = _SPELLED.match(text, m.end())
        if lo < end and tail:
            found.append((0, lo, tail.end()))
    if ":" in text:
        found += [(1, *m.span()) for m in _IPV6.finditer(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and not luhn(d):
                found.append((2, *m.span()))
    found += [(3, *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    spans = sorted((s, e) for _, s, e in taken)
    starts = [s for s, _ in spans]
    furthest = list(accumulate((b for _, b in spans), max))  # end of the spans up to here
    last = -1
    for kind, s, e in sorted(found, key=lambda x: (x[1], x[0])):
        i = int(np.searchsorted(starts, e))
        if s >= last and not (i and furthest[i - 1] > s):
            last = e
            yield kind, s, e


def votes(text: str, kind: int, s: int, e: int, strict: bool) -> int:
    """The labelers' votes on a candidate as one base-3 number, first labeler highest."""
    span, name = text[s:e], KINDS[kind]
    d = _digits(span)
    out = [YES if strict else NO if kind == 2 else NONE]
    if kind == 0:
        out.append(YES if re.split(r"[^A-Za-z]+", span)[-1].lower() in TLDS else NO)
    elif kind == 1:
        first = span.split(".")[0].lstrip("0") or "0"
        out.append(YES if ":" in span else NO if first in ("0", "127", "255") else YES)
    elif kind == 2:
        out.append(YES if d[:1] in "3456" and len(d) in (13, 14, 15, 16, 19) else NO)
    else:
        out.append(NO if len(d) == 10 and d[0] in "01" else YES)
    around = [w.lower() for w in _WORDS.findall(text[max(0, s - 40):s])[-4:] + _WORDS.findall(text[e:e + 20])[:1]]
    near = any(w in CONTEXT[name] for w in around)
    out.append(YES if near else NO if any(w in AGAINST for w in around) else NONE)
    before, after = text[s - 1:s], text[e:e + 1]
    out.append(NO if before.isalnum() or after.isalnum() or before in "#=_/" and before else YES)
    out.append((NO if len(set(d)) <= 2 else YES) if kind else (YES if len(span) <= 80 else NO))
    code = 0
    for v in out:
        code = code * 3 + v
    return code


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base_sha256, spans``: every candidate span (kind, start, end, strict, votes) of the
    whole text, code points, end exclusive; base_sha256 is the digest of the strict ones."""
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("strict", pa.bool_()),
                      ("votes", pa.int32())])

    def run(batches):
        for batch in batches:
            digests, spans = [], []
            for t in batch["text"]:
                t = t.as_py() or ""
                base = sorted(strict_spans(t), key=lambda x: (x[0], x[1]))
                digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base).encode()).hexdigest())
                rows = [(k, s, e, True, votes(t, k, s, e, True)) for k, s, e in base]
                rows += [(k, s, e, False, votes(t, k, s, e, False)) for k, s, e in loose_spans(t, base)]
                spans.append([dict(zip(("kind", "start", "stop", "strict", "votes"), r, strict=True)) for r in rows])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(digests, pa.string()), pa.array(spans, pa.list_(span))],
                                             ["doc_id", "base_sha256", "spans"])

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, base_sha256 string, spans array<struct<kind:int,start:int,stop:int,strict:boolean,votes:int>>")


def vote_matrix(codes: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELERS) - 1, -1, -1)
    return np.asarray(codes)[:, None] // powers % 3


def em_reliability(votes_: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of 'personal' per pattern, P(vote | class) per labeler (2 x labelers x 3), prior.

    Starts from the majority of votes. Counts are smoothed, with the prior belief that a labeler
    is right more often than wrong."""
    yes, no = (votes_ == YES).sum(1), (votes_ == NO).sum(1)
    post = np.clip(0.5 + 0.2 * (yes - no), 0.05, 0.95)
    belief = np.array([[1.0, 1.0, 3.0], [1.0, 3.0, 1.0]])  # pseudo counts of none, yes, no by class
    for _ in range(rounds):
        prior = float((n @ post + 1) / (n.sum() + 2))
        table = np.zeros((2, votes_.shape[1], 3))
        for c, w in ((0, n * (1 - post)), (1, n * post)):
            for v in range(3):
                table[c, :, v] = ((votes_ == v) * w[:, None]).sum(0) + belief[c][v]
        table /= table.sum(2, keepdims=True)
        like = [np.log(p) + np.log(np.take_along_axis(table[c].T, votes_, 0)).sum(1) for c, p in ((0, 1 - prior), (1, prior))]
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return post, table, prior


def span_classifier(votes_: np.ndarray, n: np.ndarray, post: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Probability per pattern from a ridge logistic regression on its votes with soft labels."""
    x = np.column_stack([np.ones(len(votes_)), votes_ == YES, votes_ == NO]).astype(float)
    w, n = np.zeros(x.shape[1]), n / max(n.sum(), 1) * min(n.sum(), 10_000)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (n * (p - post)) + w)
    return 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.9) -> DataFrame:
    """One row per document: ``doc_id, base_sha256, spans`` with spans an array of (kind name,
    start, stop, strict, probability), by kind as in KINDS and then start.

    Strict spans always stay; loose ones join at a probability of ``threshold`` or more. NULL text
    counts as empty and gives no spans; repeated rows give a row each; an empty table gives none;
    extra columns are ignored."""
    found = shared_table(candidates(docs, key, text), "spans")
    table = (found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.strict", "s.votes")
             .agg(F.count(F.lit(1)).alias("n")).toPandas())
    chance = {}
    for kind in range(len(KINDS)):
        own = table[table["kind"] == kind].groupby("votes", as_index=False)["n"].sum()
        if len(own):
            v, n = vote_matrix(own["votes"].to_numpy()), own["n"].to_numpy(float)
            post, _, _ = em_reliability(v, n)
            chance |= {kind * 243 + int(c): float(p) for c, p in zip(own["votes"], span_classifier(v, n, post), strict=True)}
    lookup = F.create_map(*[F.lit(x) for kv in (chance or {-1: 0.0}).items() for x in kv])
    name = F.array(*map(F.lit, KINDS))
    scored = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["strict"].alias("strict"),
        F.try_element_at(lookup, s["kind"] * 243 + s["votes"]).alias("probability")))
    kept = F.array_sort(F.filter(scored, lambda s: s["strict"] | (s["probability"] >= threshold)))
    named = F.transform(kept, lambda s: F.struct(
        F.get(name, s["rank"]).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
        s["strict"].alias("strict"), s["probability"].alias("probability")))
    return found.select("doc_id", "base_sha256", named.alias("spans"))
