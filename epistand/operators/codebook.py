"""Code dictionary: each distinct clinical code is matched once against all topics.

A book has one row per distinct code: ``mask`` with a bit for every topic whose code set the code
matches (D11, D12), and ``steps`` for the topics that match anywhere in the joined codes of a record
(D13), where a match may begin in one code and end in the next. For these the patterns' proper
prefixes are states; ``steps[s]`` gives the state after the code when the codes before it ended in
state s, and the topics matched on the way. Folding the steps of a record's codes gives exactly the
match on the joined text, for all topics, with one lookup a code.

The book grows with the distinct codes, not with the records. It is broadcast only while its measured
rows stay under a bound; a larger one is not joined, the patterns then run on every record.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.functions.codes import any_position_match, code_match
from epistand.params import CodeSet
from epistand.session import BROADCAST_BYTES
from epistand.sources.readers import lineage_cut

ROW_BYTES = 64  # of a book row in a broadcast relation, besides its steps
STEP_BYTES = 32


def literals(regex: str) -> list[str]:
    """The texts that a pattern of letters, digits, ``[...]`` and ``|`` matches."""
    out = []
    for part in regex.split("|"):
        pieces = re.findall(r"\[([^\]^]+)\]|([A-Za-z0-9])", part)
        if "".join(f"[{c}]" if c else x for c, x in pieces) != part or not part:
            raise ValueError(f"only letters, digits, [...] and | are understood: {regex!r}")
        ranges = lambda c: re.sub(r"(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), c)
        out += ["".join(x) for x in product(*(ranges(c) if c else x for c, x in pieces))]
    return out


@dataclass(frozen=True)
class Topics:
    """Named code sets: ``single`` on one code, ``joined`` (patterns only) on all codes of a record."""

    single: dict[str, CodeSet]
    joined: dict[str, CodeSet] = field(default_factory=dict)

    def __post_init__(self):
        if max(len(self.single), len(self.joined)) > 62:
            raise ValueError("a mask holds 62 topics: use a second book")

    @property
    def states(self) -> list[str]:
        """Proper prefixes of the joined patterns' texts, longest first; '' is the last."""
        texts = [t for c in self.joined.values() for t in literals(c.regex)]
        return sorted({t[:i] for t in texts for i in range(len(t))} | {""}, key=lambda p: (-len(p), p))

    def mask(self, code: Column) -> Column:
        """Bits of the single topics that a code matches; 0 for NULL."""
        return _bits([F.coalesce(code_match(code, c), F.lit(False)) for c in self.single.values()])

    def joined_mask(self, text: Column) -> Column:
        return _bits([F.coalesce(code_match(text, CodeSet(regex=c.regex)), F.lit(False)) for c in self.joined.values()])

    def steps(self, code: Column) -> Column:
        """array<struct<to:int, hit:bigint>>, by number of the state before the code."""
        states = self.states
        out = []
        for before in states:
            text = F.concat(F.lit(before), code)
            # the longest state that the text ends with; '' always does
            to = F.coalesce(*[F.when(F.endswith(text, F.lit(p)), F.lit(i)) for i, p in enumerate(states)])
            out.append(F.struct(to.alias("to"), self.joined_mask(text).alias("hit")))
        return F.array(*out)


def _bits(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(t, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, t in enumerate(tests)],
                  F.lit(0).cast("bigint"))


def distinct_codes(records: DataFrame, columns) -> DataFrame:
    """(code, n) of all code columns in one scan; repeats are combined before the shuffle."""
    return (records.select(F.explode(F.array(*columns)).alias("code")).where("code is not null")
            .groupBy("code").agg(F.count(F.lit(1)).alias("n")))


def build_codebook(records: DataFrame, columns, topics: Topics, book: DataFrame | None = None) -> DataFrame:
    """(code, n, mask, steps) of the distinct codes, stored in the shared checkpoint folder.

    With an earlier ``book`` of the same topics only codes that it lacks are matched; ``n`` adds up."""
    codes = distinct_codes(records, columns)
    if book is not None:
        known = codes.join(book.withColumnRenamed("n", "n0"), "code", "full").select(
            "code", (F.coalesce("n", F.lit(0)) + F.coalesce("n0", F.lit(0))).alias("n"), F.col("mask").alias("m0"), F.col("steps").alias("s0"))
        new = known.select("code", "n", F.coalesce("m0", topics.mask(F.col("code"))).alias("mask"),
                           F.coalesce("s0", topics.steps(F.col("code"))).alias("steps"))
        return lineage_cut(new)
    return lineage_cut(codes.select("code", "n", topics.mask(F.col("code")).alias("mask"), topics.steps(F.col("code")).alias("steps")))


def with_topics(records: DataFrame, book: DataFrame, topics: Topics, single: str, joined=(),
                bound: int = BROADCAST_BYTES) -> DataFrame:
    """``records`` with ``topic_mask`` (of the ``single`` column) and ``joined_mask`` (of the ``joined``
    columns in this order, NULLs skipped), looked up in ``book``.

    A code that the book lacks stops the job. The book is broadcast if its rows, counted here, are
    under ``bound`` bytes; else the patterns run on the records, with the same result."""
    if book.count() * (ROW_BYTES + STEP_BYTES * len(topics.states)) > bound:
        text = F.concat_ws("", *joined) if joined else F.lit(None).cast("string")
        return records.withColumns({"topic_mask": topics.mask(F.col(single)), "joined_mask": topics.joined_mask(text)})
    out = records
    columns = list(dict.fromkeys([single, *joined]))
    for i, c in enumerate(columns):
        entry = book.select(F.col("code").alias(f"_c{i}"), F.struct(F.col("mask"), F.col("steps")).alias(f"_b{i}"))
        out = out.join(F.broadcast(entry), F.col(c) == F.col(f"_c{i}"), "left").drop(f"_c{i}")
    entry = {c: F.when(F.col(c).isNotNull() & F.col(f"_b{i}").isNull(), F.raise_error(F.concat(F.lit("code not in the book: "), F.col(c))))
             .otherwise(F.col(f"_b{i}")) for i, c in enumerate(columns)}
    # a condition used for its error only: never true
    out = out.withColumn("topic_mask", F.coalesce(entry[single]["mask"], F.lit(0).cast("bigint")))
    begin = F.struct(F.lit(len(topics.states) - 1).alias("state"), F.lit(0).cast("bigint").alias("hits"))
    follow = lambda a, s: F.when(s.isNull(), a).otherwise(F.struct(
        s[a["state"]]["to"].alias("state"), a["hits"].bitwiseOR(s[a["state"]]["hit"]).alias("hits")))
    fold = F.aggregate(F.array(*[entry[c]["steps"] for c in joined]), begin, follow)["hits"] if joined else F.lit(0).cast("bigint")
    return out.withColumn("joined_mask", fold).drop(*[f"_b{i}" for i in range(len(columns))])


def flag(mask: str, names, name: str) -> Column:
    """1 if the topic's bit is set, else 0."""
    return F.getbit(F.col(mask), F.lit(list(names).index(name))).cast("int")


def stay_topics(records: DataFrame, topics: Topics) -> DataFrame:
    """One row per stay with a 0/1 column for every topic (largest over its episodes): the masks are
    OR-ed, partially before the one shuffle, whatever the number of topics."""
    either = F.col("topic_mask").bitwiseOR(F.col("joined_mask"))
    stays = (records.where(either != 0).groupBy(F.col("link_no").alias("linkno"), F.col("cis_marker").alias("cis"))
             .agg(F.bit_or("topic_mask").alias("_m"), F.bit_or("joined_mask").alias("_j")))
    return stays.select("linkno", "cis", *[flag("_m", topics.single, t).alias(t) for t in topics.single],
                        *[flag("_j", topics.joined, t).alias(t) for t in topics.joined])


def same_as_patterns(records: DataFrame, topics: Topics, single: str, joined) -> Column:
    """True where the looked-up masks equal the patterns run on the record (a check of the book)."""
    text = [any_position_match(list(joined), c) for c in topics.joined.values()]
    return (F.col("topic_mask") == topics.mask(F.col(single))) & (F.col("joined_mask") == _bits([F.coalesce(t, F.lit(False)) for t in text]))
