"""Multiple sclerosis: death counts and incidence with a 10-year look-back from the previous
discharge, by sex and by sex and age group."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.operators.charts import band_chart, chart_data
from epistand.operators.counts import counts_with_total
from epistand.operators.population import population_cells
from epistand.operators.residency import resident_by_country
from epistand.params import MS_BANDS, MS_CODES, LookbackParams
from epistand.plans.incidence_topics import incidence_cells, stacked_stays, topic_deaths

# The age-group names shown in the chart, per coarse band.
BAND_NAMES = {1: "<25", 2: "25-59", 3: "60+"}


@dataclass(frozen=True)
class MsParams:
    death_window: tuple = (date(2003, 1, 1), date(2023, 12, 31))
    stay_window: tuple = (date(1991, 4, 1), date(2024, 3, 31))
    population_years: tuple = (2003, 2023)
    output_after_year: int = 2001
    dropped_label: str = "2002/03"
    lookback: LookbackParams = field(default_factory=lambda: LookbackParams(gap_from="dodis"))
    bands: tuple = MS_BANDS


def deaths(src, p: MsParams) -> DataFrame:
    return topic_deaths(src.deaths, MS_CODES, p.death_window)


def death_chart(src, p: MsParams) -> DataFrame:
    counts = counts_with_total(deaths(src, p).withColumnRenamed("year_of_registration", "cal_year"),
                               keep_unmatched=False)
    return counts.select(F.col("cal_year").alias("class1"), F.col("n").alias("measure"),
                         F.col("sex").alias("class2"))


def incidence(src, p: MsParams) -> DataFrame:
    stays = stacked_stays(src, MS_CODES, p.stay_window)
    pop = population_cells(src.population, *p.population_years)
    return incidence_cells(stays, resident_by_country(deaths(src, p)), src.postcode_lookup, pop, p.bands,
                           p.lookback, p.output_after_year, how="full")


def chart1(inc: DataFrame, p: MsParams) -> DataFrame:
    return (chart_data(inc, 100000).where(F.col("year") != p.dropped_label)
            .select(F.col("year").alias("class2"), F.col("rate").alias("measure"), F.col("sex").alias("class1")))


def chart2(inc: DataFrame, p: MsParams) -> DataFrame:
    out = band_chart(inc, p.bands, [BAND_NAMES[b.label] for b in p.bands])
    label = F.when(F.col("sex").isin("Male", "Female"), F.concat_ws(" ", "sex", "band"))
    out = out.select("year", "rate", label.alias("class1"))
    return (out.where(F.col("year") != p.dropped_label)
            .select(F.col("year").alias("class2"), F.col("rate").alias("measure"), "class1"))


def run(src, p: MsParams = MsParams()) -> dict[str, DataFrame]:
    """The incidence cells feed both charts: materialised once."""
    from epistand.sources.readers import lineage_cut
    inc = lineage_cut(incidence(src, p))
    return {"mortality_chart1": death_chart(src, p), "seccare_chart1_pra": chart1(inc, p),
            "seccare_chart2_pra": chart2(inc, p)}
