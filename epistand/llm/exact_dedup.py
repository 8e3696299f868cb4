"""Exact dedup by a tree of grouped digest aggregates, in DataFrame operations only.

Each input partition makes a run of (digest, best row, copies). In round r the runs whose numbers
agree after division by ``fan_in ** r`` are aggregated by (run, digest), with a shuffle a level;
nothing is sorted. Grouping stands in for a merge of sorted runs because DataFrame operations have
no merge of two sorted partitions. Each level keeps, per digest, the verified row that stays and
the number of copies.
A level's merge is dealt out by (run, digest), so no task holds a whole run, and a digest with a
third of all rows is one entry per run from the first level on. The results then travel back down
the same tree, so that the final join has keys (run, digest) too and never one hot digest.

Verified: two texts are one group only if SHA-256, byte length and a second 64-bit hash agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epistand.llm.common import folded, shared_table

_SAME = ["digest", "n_bytes", "second"]


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest",
                fan_in: int = 16) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty, and empty texts
    form a group as any other. The row with the smallest (or ``keep='largest'``) key stays; a NULL
    key stays only if its whole group has none (keep_id is NULL then). Of repeated rows (same key
    and text) exactly one has kept = true. Other columns, whatever their names, are ignored. An
    empty table gives no rows."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    body = folded(docs[text])
    leaves = docs.select(docs[key].cast("long").alias("id"), body.alias("body"))
    leaves = leaves.select(
        "id", F.unhex(F.sha2("body", 256)).alias("digest"), F.octet_length("body").alias("n_bytes"),
        F.xxhash64("body").alias("second"), F.monotonically_increasing_id().alias("rid"),
        F.spark_partition_id().alias("run"))
    leaves = shared_table(leaves, "runs")
    top = leaves.agg(F.max("run")).first()[0] or 0

    if keep == "smallest":
        mine, best = F.struct(F.isnull("id").alias("none"), "id", "rid"), F.min
    else:
        mine, best = F.struct(F.isnotnull("id").alias("some"), "id", (-F.col("rid")).alias("rid")), F.max
    level = (leaves.select("run", *_SAME, mine.alias("best")).groupBy("run", *_SAME)
             .agg(best("best").alias("best"), F.count(F.lit(1)).alias("copies")))
    levels = [shared_table(level, "level0")]
    while top > 0:
        top //= fan_in
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        up = up.groupBy("run", *_SAME).agg(best("best").alias("best"), F.sum("copies").alias("copies"))
        levels.append(shared_table(up, f"level{len(levels)}"))

    found = levels.pop()
    while levels:
        below = levels.pop().select("run", *_SAME)
        parent = found.withColumnRenamed("run", "parent")
        found = (below.withColumn("parent", F.floor(F.col("run") / fan_in).cast("int"))
                 .join(parent, ["parent", *_SAME]).drop("parent"))
    rid = F.col("best.rid") if keep == "smallest" else -F.col("best.rid")
    return (leaves.join(found, ["run", *_SAME])
            .select(F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"),
                    F.col("copies").cast("long").alias("group_size"), (F.col("rid") == rid).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts.

    Of repeated rows (same key and text) the first in the order of the remaining columns stays."""
    stay = (exact_dedup(docs, key, text, keep).where("kept")
            .select(F.col("text_sha256").alias("__sha"), F.coalesce(F.col("keep_id").cast("string"), F.lit(""))
                    .alias("__key")))
    keyed = docs.withColumns({"__sha": F.sha2(folded(docs[text]), 256),
                              "__key": F.coalesce(docs[key].cast("long").cast("string"), F.lit(""))})
    order = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)] + [F.col(f"`{text}`")]
    w = Window.partitionBy("__sha", "__key").orderBy(*order)
    return (keyed.join(stay, ["__sha", "__key"]).withColumn("__nr", F.row_number().over(w))
            .where("__nr = 1").select(*[F.col(f"`{c}`") for c in docs.columns]))
