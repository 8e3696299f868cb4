"""Populations stored by year, so that a rate reads the years of its events only.

The events' years are few (one row a year at most), so they are broadcast; Spark turns the semi-join
into a partition filter that is known before the population is listed."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.operators.cells import CELL_KEYS, with_denominators
from epistand.operators.population import population_cells
from epistand.session import ensure_checkpoint_dir
from epistand.sources.patient_table import drop_superseded, fingerprint, folder_exists

INPUTS = ("orders", "customer")
MOST_YEARS = 10_000  # calendar years from 1 to 9999: the bound of the broadcast


def population_by_year(src) -> DataFrame:
    """The source's population, written once for each state of its files as one folder per year."""
    spark = src.spark
    name = "population-" + os.path.basename(os.path.normpath(src.sf_dir))
    done = f"base-{name}-{fingerprint(spark, [os.path.join(src.sf_dir, f'{t}.parquet') for t in INPUTS], 'population-1')}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{done}"
    if not folder_exists(spark, f"{path}/_SUCCESS"):
        src.population.repartition("year").write.mode("overwrite").partitionBy("year").parquet(path)
    drop_superseded(spark, f"base-{name}-", done)
    return spark.read.parquet(path)


def of_event_years(population: DataFrame, cells: DataFrame) -> DataFrame:
    """The population of the years that ``cells`` has; other years' folders are not read."""
    years = cells.where(F.col("year").between(1, MOST_YEARS - 1)).select("year").distinct()
    return population.join(F.broadcast(years), "year", "left_semi")


def left_cells(counts: DataFrame, population: DataFrame, keys=CELL_KEYS) -> DataFrame:
    """``with_denominators(..., how="left")`` of a population stored by year (years 1 to 9999)."""
    return with_denominators(counts, population_cells(of_event_years(population, counts)), keys, how="left")
