"""Top causes of death as a share of all deaths, per published release."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epistand.params import (CAUSE_RELABEL, CAUSE_SUBTRACTION, EXCLUDED_CAUSES, TOP_CAUSES_N, TOTAL_CAUSE)


def subtract_category(df: DataFrame, cat: str, value: str, target: str, minus: str, partition: str) -> DataFrame:
    """value(target) -= value(minus) within each partition (a missing ``minus`` row counts 0)."""
    w = Window.partitionBy(partition)
    other = F.max(F.when(F.col(cat) == minus, F.col(value))).over(w)
    return df.withColumn(value, F.when(F.col(cat) == target, F.col(value) - F.coalesce(other, F.lit(0.0)))
                         .otherwise(F.col(value)))


def top_causes(clean: DataFrame, ages=None, exclude_ages=None, n: int = TOP_CAUSES_N, release: str = "release",
               code: str = "ICD_10_code", cause: str = "cause_of_death") -> DataFrame:
    """Share of deaths (1 decimal) of the n largest causes, per release.

    Sums deaths over both sexes and the chosen age columns; the total is the largest cause (the
    all-causes row); summary groups (names with "."), the total and the excluded groups are
    dropped; poisonings are relabelled and subtracted from accidents; the n largest shares are
    kept (ties by code and name) and numbered in ascending order of share for display.
    Every window is partitioned by release: one published table is tens of rows."""
    df = clean.where(F.col("sex") != "All")
    if ages is not None:
        df = df.where(F.col("age").isin(list(ages)))
    if exclude_ages is not None:
        df = df.where(~F.col("age").isin(list(exclude_ages)))
    per_release = Window.partitionBy(release)
    g = (df.groupBy(release, code, cause).agg(F.sum("num_deaths").alias("number_deaths"))
         .withColumn("total_deaths", F.max("number_deaths").over(per_release))
         .where(F.col(cause) != TOTAL_CAUSE)
         .where(~F.col(cause).contains("."))
         .where(~F.col(cause).isin(list(EXCLUDED_CAUSES))))
    relabel = None
    for old, new in CAUSE_RELABEL.items():
        relabel = (F.when(F.col(cause) == old, F.lit(new)) if relabel is None
                   else relabel.when(F.col(cause) == old, F.lit(new)))
    g = g.withColumn(cause, relabel.otherwise(F.col(cause)))
    g = subtract_category(g, cause, "number_deaths", *CAUSE_SUBTRACTION, partition=release)
    g = g.withColumn("measure", F.round(F.try_divide(F.col("number_deaths"), F.col("total_deaths")) * 100, 1))
    pick = Window.partitionBy(release).orderBy(F.col("measure").desc(), F.col(code), F.col(cause))
    show = Window.partitionBy(release).orderBy(F.col("measure").asc(), F.col(code), F.col(cause))
    top = g.withColumn("_rank", F.row_number().over(pick)).where(F.col("_rank") <= n)
    return top.select(release, F.col(cause).alias("class1"), "measure",
                      F.row_number().over(show).alias("position"))
