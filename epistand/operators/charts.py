"""Chart-ready tables: rates with year and sex labels, label columns from keys, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.functions.dates import year_label
from epistand.functions.labels import sex_label
from epistand.operators.standardise import band_rates, standardised_rates


def chart_data(cells: DataFrame, epop_total, by_sex: bool = True,
               year_type: str = "financial") -> DataFrame:
    """Standardise, then keep (year label, sex label, rate); the both-sex form has sex 'All'.
    Returns the frame; writing it is a separate sink call."""
    rates = standardised_rates(cells, epop_total, by_sex=by_sex)
    if by_sex:
        return rates.select(year_label("year", year_type).alias("year"),
                            sex_label("sex").alias("sex"), "rate")
    return rates.select(year_label("year", year_type).alias("year"), "rate",
                        F.lit("All").alias("sex"))


def band_chart(cells: DataFrame, bands, names, year_type: str = "financial") -> DataFrame:
    """(year label, sex label, rate, band): the rates of every coarse band in one pass, ``band``
    taken from ``names`` in the order of ``bands``."""
    rates = band_rates(cells, bands)
    return rates.select(year_label("year", year_type).alias("year"), sex_label("sex").alias("sex"), "rate",
                        label_from_keys({b.label: n for b, n in zip(bands, names)}, ["age_grp"]).alias("band"))


def label_from_keys(mapping: dict, cols) -> Column:
    """CASE over tuples of key values -> label; unmatched combinations give NULL."""
    expr = None
    for key, label in mapping.items():
        key = key if isinstance(key, tuple) else (key,)
        cond = None
        for c, v in zip(cols, key):
            part = F.col(c).cast("string") == F.lit(str(v))
            cond = part if cond is None else cond & part
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def split_charts(charts: DataFrame, names) -> dict[str, DataFrame]:
    """One frame per chart name, for separately written files; ``charts`` should be materialised."""
    return {n: charts.where(F.col("chart") == F.lit(n)).drop("chart") for n in names}


def project_chart(df: DataFrame, columns: dict, where: Column | None = None) -> DataFrame:
    """Select columns under chart names ({new: old}) after an optional row predicate."""
    if where is not None:
        df = df.where(where)
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])
