"""Cells: event counts per (year, age band, sex, ...) joined to population denominators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from epistand.functions.ages import epop_weight

CELL_KEYS = ("year", "age_grp", "sex")


def count_cells(events: DataFrame, keys) -> DataFrame:
    """Number of events per cell (column ``n``). Partial counts are combined before the shuffle."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on keys where NULL matches NULL (as data-frame joins in the method do); key columns
    are coalesced from both sides, the other columns are kept from each side."""
    lk = {k: f"__l_{k}" for k in keys}
    rk = {k: f"__r_{k}" for k in keys}
    l2 = left.withColumnsRenamed(lk)
    r2 = right.withColumnsRenamed(rk)
    cond = [F.col(lk[k]).eqNullSafe(F.col(rk[k])) for k in keys]
    joined = l2.join(r2, on=cond, how=how)
    key_cols = [F.coalesce(F.col(lk[k]), F.col(rk[k])).alias(k) for k in keys]
    rest = [c for c in joined.columns if c not in lk.values() and c not in rk.values()]
    return joined.select(*key_cols, *rest)


def watch_denominators(cells: DataFrame, audit: Observation) -> DataFrame:
    """``cells`` unchanged, with the counts of ``without_denominator`` (all years together) taken in the
    pass that computes the rates: ``audit.get`` has cells, cells_without and events_without once an
    action on anything derived from the result has run."""
    missing = F.col("denominator").isNull() | (F.col("denominator") == 0)
    return cells.observe(audit, F.count(F.lit(1)).alias("cells"), F.count_if(missing).alias("cells_without"),
                         F.coalesce(F.sum(F.when(missing, F.col("numerator"))), F.lit(0)).cast("long").alias("events_without"))


def without_denominator(cells: DataFrame, keys=("year",)) -> DataFrame:
    """Per key: the cells (and their events) that have no usable denominator, which a rate leaves out."""
    missing = F.col("denominator").isNull() | (F.col("denominator") == 0)
    return (cells.where(missing).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("cells"), F.coalesce(F.sum("numerator"), F.lit(0)).alias("events")))


def with_denominators(cells: DataFrame, population: DataFrame, keys=CELL_KEYS, how: str = "full",
                      zero_fill: bool = True, add_epop: bool = True) -> DataFrame:
    """Join counts (``n``) to populations (``pop``) and name them numerator / denominator.

    ``how='full'`` keeps population cells without events (numerator 0 after zero-fill) and event
    cells without population (denominator NULL). Both sides are already aggregated to at most
    bands x sexes x years rows, so this join is small whatever the input size."""
    out = null_safe_join(cells, population, list(keys), how)
    out = out.withColumnsRenamed({"n": "numerator", "pop": "denominator"})
    if zero_fill:
        out = out.withColumn("numerator", F.coalesce(F.col("numerator"), F.lit(0)))
    if add_epop:
        out = out.withColumn("epop", epop_weight("age_grp"))
    return out
