"""Population denominators: single-year populations banded to cells, and area populations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.ages import age_band


def population_cells(pop: DataFrame, first_year: int | None = None, last_year: int | None = None,
                     year_col: str = "year") -> DataFrame:
    """Filter years, band ages and sum population by (age_grp, sex, year)."""
    if first_year is not None:
        pop = pop.where(F.col(year_col) >= first_year)
    if last_year is not None:
        pop = pop.where(F.col(year_col) <= last_year)
    return (pop.groupBy(age_band("age").alias("age_grp"), F.col("sex").cast("string").alias("sex"),
                        F.col(year_col).alias("year"))
            .agg(F.sum("pop").alias("pop")))


def wide_age_columns(df: DataFrame, prefix: str = "age") -> list[str]:
    """Names of the single-year age columns (``age65`` .. ``age90plus``), in table order."""
    return [c for c in df.columns if c.startswith(prefix) and c[len(prefix):len(prefix) + 1].isdigit()]


def area_population_long(pop_wide: DataFrame, year: int, first_age: int,
                         area: str = "datazone2011") -> DataFrame:
    """Wide area populations (one column per single year of age) -> banded long cells.

    Keeps the ages from ``first_age``; the open-ended top column (``age90plus``) counts as its
    lower age. Sex 'M'/'F' becomes '1'/'2'. Sums by (year, area, age_grp, sex)."""
    cols = [c for c in wide_age_columns(pop_wide)
            if int("".join(ch for ch in c[3:] if ch.isdigit())) >= first_age]
    long = (pop_wide.where(F.col("year") == year)
            .select("year", area, "sex", *cols)
            .unpivot(["year", area, "sex"], cols, "age", "pop"))
    # The parsed age is its own column: grouping directly on a band of the parsed text trips a
    # code-generation failure in Spark (the query still runs, but interpreted).
    long = long.withColumn("age", F.regexp_extract("age", r"(\d+)", 1).try_cast("int"))
    return (long.groupBy("year", area, age_band("age").alias("age_grp"),
                         F.when(F.col("sex") == "M", "1").when(F.col("sex") == "F", "2").alias("sex"))
            .agg(F.coalesce(F.sum("pop"), F.lit(0)).alias("pop")))
