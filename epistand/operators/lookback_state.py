"""Incremental look-back: yearly re-runs from a state table instead of the whole history.

The state keeps, of every record seen, only what the look-back and the counts need: patient, the
record's place in the total order, the date that a gap is measured from, some columns named by the
caller, and whether the record is incident. A batch of new records (usually one year) is merged with
the state rows of its own patients: the lag over both gives the batch's incident records and, where
a record arrives late, the earlier records whose answer it changes. The history itself is not read
again, and no record is too late.

The state lies in numbered generations under one folder. A generation counts once its head entry,
written last, stands, so a step that fails leaves the one before in force and can be repeated; a step
with the label of the last one replaces it. The generation in force and its parent are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistand.operators.incidence import is_incident, previous_record
from epistand.params import LookbackParams
from epistand.sources.patient_table import delete_folder, folder_exists



@dataclass(frozen=True)
class Step:
    """``incident``: the batch's incident records; ``changes``: earlier records whose answer changed
    (``was``, ``now``); ``counts``: records, incident ones and changes of the step."""

    label: str
    incident: DataFrame
    changes: DataFrame
    counts: dict


class LookbackState:
    """Look-back over batches that arrive one after the other.

    ``keep`` names further record columns that the state carries along. Batches may differ in their
    other columns; ``patient``, ``admitted``, ``rank``, ``stay`` and the gap date are read from all."""

    def __init__(self, spark: SparkSession, folder: str, lookback: LookbackParams, keep=(), patient: str = "linkno",
                 admitted: str = "doadm", rank: str = "source_rank", stay: str = "cis"):
        self.spark, self.folder, self.lookback = spark, folder.rstrip("/"), lookback
        self.patient, self.admitted, self.ties = patient, admitted, (rank, stay)
        self.columns = list(dict.fromkeys([patient, admitted, rank, stay, lookback.gap_from, *keep]))

    def _path(self, generation: int, part: str) -> str:
        return f"{self.folder}/gen-{generation:06d}/{part}"

    def _heads(self) -> list:
        """(generation, parent, label) of every finished step, oldest first."""
        head = f"{self.folder}/head"
        return sorted(self.spark.read.parquet(head).collect()) if folder_exists(self.spark, head) else []

    def generation(self) -> int:
        """Number of the generation in force; 0 before the first step."""
        return max((h["generation"] for h in self._heads()), default=0)

    def rows(self, generation: int | None = None) -> DataFrame | None:
        """State rows (``columns``, ``_order``, ``incident``) of a generation, by default that in force."""
        n = self.generation() if generation is None else generation
        return self.spark.read.parquet(self._path(n, "state")) if n else None

    def incident(self) -> DataFrame:
        """All records seen so far that are incident, with the state's columns."""
        rows = self.rows()
        if rows is None:
            raise ValueError("no batch yet")
        return rows.where("incident").select(*self.columns)

    def advance(self, batch: DataFrame, label: str) -> Step:
        """Merge a batch of new records; see the class. Every record is new: one that is given twice
        counts twice, as in the whole history."""
        spark, heads = self.spark, self._heads()
        last = heads[-1] if heads else {"generation": 0, "parent": 0, "label": None}
        # a repeated step starts from the state before it
        parent = last["parent"] if last["label"] == label else last["generation"]
        n = last["generation"] + 1
        new = batch.select(*self.columns, F.xxhash64(*[F.col(c) for c in sorted(batch.columns)]).alias("_order"), F.lit(None).cast("boolean").alias("was"))
        new.write.mode("overwrite").parquet(self._path(n, "batch"))
        new = spark.read.schema(new.schema).parquet(self._path(n, "batch"))
        before = self.rows(parent) if parent else None
        rest, merged = None, new
        if before is not None:
            # the state rows of this batch's patients; the others pass unread by the lag
            of_batch = new.select(F.col(self.patient).alias("_p")).distinct().withColumn("_hit", F.lit(True))
            marked = before.join(of_batch, F.col(self.patient).eqNullSafe(F.col("_p")), "left").drop("_p")
            rest = marked.where(F.col("_hit").isNull()).select(*self.columns, "_order", "incident")
            merged = marked.where("_hit").select(*self.columns, "_order", F.col("incident").alias("was")).unionByName(new)
        lagged = previous_record(merged, self.lookback.gap_from, self.patient, self.admitted, self.ties, F.col("_order"))
        answered = lagged.select(*self.columns, "_order", "was", is_incident(
            self.admitted, "_previous", self.lookback.min_gap_years, self.lookback.days_per_year).alias("incident"))
        answered.write.mode("overwrite").parquet(self._path(n, "merged"))
        answered = spark.read.parquet(self._path(n, "merged"))
        state = answered.select(*self.columns, "_order", "incident")
        (state if rest is None else rest.unionByName(state)).write.mode("overwrite").parquet(self._path(n, "state"))
        known = F.col("was").isNotNull()
        counts = answered.agg(F.count_if(~known).alias("records"), F.count_if(~known & F.col("incident")).alias("incident"),
                              F.count_if(known & F.col("was") & ~F.col("incident")).alias("withdrawn"),
                              F.count_if(known & ~F.col("was") & F.col("incident")).alias("added")).first().asDict()
        head = spark.createDataFrame([(n, parent, label)], "generation int, parent int, label string")
        head.coalesce(1).write.mode("append").parquet(f"{self.folder}/head")
        for old in heads:
            if old["generation"] != parent:
                delete_folder(spark, f"{self.folder}/gen-{old['generation']:06d}")
        changes = answered.where(known & (F.col("was") != F.col("incident"))).select(*self.columns, "was", F.col("incident").alias("now"))
        return Step(label, answered.where(~known & F.col("incident")).select(*self.columns), changes, counts)
