"""Counts with a both-sex total, computed in one pass with grouping sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.labels import sex_label


def counts_with_total(df: DataFrame, year_col: str = "cal_year", sex_col: str = "sex",
                      total_label: str = "All", keep_unmatched: bool = True,
                      count_col: str = "n") -> DataFrame:
    """Counts by year and by (sex, year), one grouped scan: ``GROUPING SETS ((year), (sex, year))``.

    The total row is recognised by ``grouping(sex)``, never by a NULL sex, so records whose sex is
    NULL keep their own row. Sex codes are labelled Male/Female; other codes are kept (or NULL)."""
    g = (df.groupingSets([[year_col], [sex_col, year_col]], year_col, sex_col)
         .agg(F.count(F.lit(1)).alias(count_col), F.grouping(sex_col).alias("_total")))
    label = F.when(F.col("_total") == 1, F.lit(total_label)).otherwise(sex_label(sex_col, keep_unmatched))
    return g.select(F.col(year_col), label.alias(sex_col), F.col(count_col))
