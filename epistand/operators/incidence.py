"""Incident events with a look-back window.

An event is incident when the patient has no previous record, or when the gap from the
immediately previous record (its discharge, or its admission) is at least ``min_gap_years``
(days / 365). Records are ordered per patient by admission date, then source (deaths first),
then stay id, then a hash of
the whole record, so that ties have one order everywhere.

Scale: a plain ``lag`` over ``partitionBy(patient)`` puts all of a patient's records into one
task. Here the records are cut into ranges of the full order, so that even one patient-day with a
large share of the rows spreads over ranges, and are written once with their range number (range
bounds may differ between runs of one plan, so they must not be computed twice). The lag runs
within (range, patient); only the first record of a range's first patient looks further back, to
the last record of the range before it, which is one row per range. The result is exactly the
whole-history lag, for any date and any type of stay id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epistand.functions.dates import years_between
from epistand.session import ensure_checkpoint_dir


def _record_order(columns, patient: str, admitted: str, tie_breakers, last=None) -> list:
    """Total order: patient, date (NULL last), tie breakers (NULL first), hash of the record."""
    last = F.xxhash64(*[F.col(c) for c in columns]) if last is None else last
    return [F.col(patient).asc_nulls_first(), F.col(admitted).asc_nulls_last(),
            *[F.col(c).asc_nulls_first() for c in tie_breakers], last.asc()]


def previous_record(events: DataFrame, gap_from: str, patient: str = "linkno", admitted: str = "doadm",
                    tie_breakers=("source_rank", "cis"), last: Column | None = None, ranges: int | None = None) -> DataFrame:
    """``events`` with ``_previous``: ``gap_from`` of the patient's record before (see module docstring).

    ``last`` ends the order (default: a hash of all columns). Runs the upstream once when called: the
    records, as they come in, are written as Parquet to the shared checkpoint folder in ``ranges``
    ranges (default: four for each shuffle partition)."""
    spark = events.sparkSession
    cols = events.columns
    last = F.xxhash64(*[F.col(c) for c in cols]) if last is None else last
    order = _record_order(cols, patient, admitted, tie_breakers, last)
    n = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lookback-{uuid.uuid4().hex}"
    cut = events.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)

    w = Window.partitionBy("_range", patient).orderBy(*order[1:])
    lagged = cut.select("*", F.lag(gap_from).over(w).alias("_prev_in"), F.lag(F.lit(1)).over(w).isNull().alias("_first"))
    # the last record of each range in the order above, as a struct that compares like it
    key = F.struct(F.col(patient).isNotNull(), F.col(patient), F.col(admitted).isNull(), F.col(admitted),
                   *[x for c in tie_breakers for x in (F.col(c).isNotNull(), F.col(c))], last)
    ends = cut.groupBy("_range").agg(F.max_by(F.struct(F.col(patient).alias("who"), F.col(gap_from).alias("ref")), key).alias("last"))
    kinds = {f.name: f.dataType for f in ends.schema["last"].dataType.fields}
    ends = sorted(ends.collect(), key=lambda r: r["_range"])  # one row per range
    schema = T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_who", kinds["who"]), T.StructField("_carry", kinds["ref"])])
    carry = spark.createDataFrame([(b["_range"], a["last"]["who"], a["last"]["ref"]) for a, b in zip(ends, ends[1:])], schema)
    joined = lagged.join(carry, "_range", "left")
    prev = F.when(~F.col("_first"), F.col("_prev_in")).when(F.col("_who").eqNullSafe(F.col(patient)), F.col("_carry"))
    return joined.select(*cols, prev.alias("_previous"))


def is_incident(admitted: str, previous: str, min_gap_years: float, days_per_year: float) -> Column:
    gap = years_between(admitted, previous, days_per_year)
    return gap.isNull() | (gap >= F.lit(float(min_gap_years)))


def incident_events(events: DataFrame, gap_from: str = "dodis", min_gap_years: float = 10.0,
                    days_per_year: float = 365.0, patient: str = "linkno", admitted: str = "doadm",
                    rank: str = "source_rank", stay: str = "cis", ranges: int | None = None) -> DataFrame:
    """Keep the incident events (see module docstring); returns the input columns. Runs the upstream
    once when called."""
    found = previous_record(events, gap_from, patient, admitted, (rank, stay), ranges=ranges)
    return found.where(is_incident(admitted, "_previous", min_gap_years, days_per_year)).select(*events.columns)


def incident_events_simple(events: DataFrame, gap_from: str = "dodis", min_gap_years: float = 10.0,
                           days_per_year: float = 365.0, patient: str = "linkno",
                           admitted: str = "doadm", tie_breakers=("source_rank", "cis")) -> DataFrame:
    """Reference form: one window over each patient's whole history (used to test the above)."""
    w = Window.partitionBy(patient).orderBy(*_record_order(events.columns, patient, admitted, tie_breakers)[1:])
    gap = years_between(admitted, F.lag(gap_from).over(w), days_per_year)
    return (events.withColumn("_gap", gap)
            .where(F.col("_gap").isNull() | (F.col("_gap") >= F.lit(float(min_gap_years))))
            .drop("_gap"))
