"""Directly age-sex-standardised rates and the ways cells are combined before standardising.

    rate(g) = 100000 / epop_total * sum over cells in g of numerator * epop / denominator

Every operator here runs on cells that are already aggregated (bands x sexes x years x
categories), so their shuffles carry a few thousand rows at most whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epistand.functions.ages import band_epop_total, coarse_band_from_grp


def _dedup(keys):
    return list(dict.fromkeys(keys))


def _sum0(c: str) -> Column:
    """NULL-skipping sum that gives 0 for a group of NULLs (as ``sum(na.rm = TRUE)``)."""
    return F.coalesce(F.sum(c), F.lit(0)).alias(c)


def easr_term() -> Column:
    """numerator * epop / denominator; a missing or zero denominator gives NULL (skipped later)."""
    return F.try_divide(F.col("numerator").cast("double") * F.col("epop").cast("double"),
                        F.col("denominator").cast("double"))


def standardised_rates(cells: DataFrame, epop_total, by_sex: bool = True, cats=()) -> DataFrame:
    """Group cells by categories + year (+ sex) and standardise.

    ``epop_total`` is a number or a Column over the group keys (one total per coarse band).
    Output: group keys, numerator (sum of counts), rate per 100,000."""
    keys = _dedup(list(cats) + ["year"] + (["sex"] if by_sex else []))
    grouped = (cells.withColumn("easr_first", easr_term())
               .groupBy(*keys)
               .agg(F.coalesce(F.sum("numerator"), F.lit(0)).alias("numerator"),
                    F.coalesce(F.sum("easr_first"), F.lit(0.0)).alias("easr_first")))
    total = epop_total if isinstance(epop_total, Column) else F.lit(float(epop_total))
    return (grouped.withColumn("rate", F.col("easr_first") / total * F.lit(100000.0))
            .drop("easr_first"))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of the numeric columns of a frame, in order, without ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def collapse_bands(cells: DataFrame, band_col: str = "age_grp2",
                   sum_cols=("numerator", "denominator", "epop"), bands=None) -> DataFrame:
    """Sum numerator, denominator and epop into coarse bands, then call the band ``age_grp``.

    Standardising the result with the band's EPOP total gives the crude rate of the band when all
    its cells are present. Cells whose band is NULL (population-only cells after a full join,
    whose band came from the event side) form their own NULL band, as in the method. Pass
    ``bands`` to derive the band from ``age_grp`` on every cell instead."""
    if bands is not None:
        cells = cells.withColumn(band_col, coarse_band_from_grp("age_grp", bands))
    if sum_cols is None:
        sum_cols = numeric_columns(cells, exclude=("year", band_col, "sex", "age_grp"))
    return (cells.groupBy("year", band_col, "sex")
            .agg(*[_sum0(c) for c in sum_cols])
            .withColumnRenamed(band_col, "age_grp"))


def band_rates(cells: DataFrame, bands) -> DataFrame:
    """Every coarse band collapsed and standardised with its own EPOP total (crude rate of the
    band), all bands in one grouped pass."""
    collapsed = collapse_bands(cells)
    inside = collapsed.where(F.col("age_grp").isin([b.label for b in bands]))
    return standardised_rates(inside, band_epop_total("age_grp", bands), cats=["age_grp"])


def pooled_both_sexes(cells: DataFrame, keys=("year", "age_grp", "age_grp2", "type"),
                      sum_cols=("numerator", "denominator", "epop"), label: str = "All") -> DataFrame:
    """Add the sexes together cell by cell (numerator, denominator and epop) and label the result
    as one sex; standardised with a 200000 total this is the pooled both-sex rate."""
    return (cells.groupBy(*keys).agg(*[_sum0(c) for c in sum_cols])
            .withColumn("sex", F.lit(label)))


def rates_within_bands(cells: DataFrame, bands, band_col: str = "age_grp2", by_sex: bool = True,
                       cats=()) -> DataFrame:
    """Standardise within each coarse band over its own five-year cells, using the band's EPOP
    total: one grouped pass instead of a filter and a union per band."""
    labels = [b.label for b in bands]
    inside = cells.where(F.col(band_col).isin(labels))
    return standardised_rates(inside, band_epop_total(band_col, bands), by_sex=by_sex,
                              cats=[band_col, *cats])
