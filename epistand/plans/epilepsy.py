"""Epilepsy: death counts (with a both-sex total) and incidence with a 10-year look-back from the
previous admission, by sex and by sex and age group."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.operators.charts import band_chart, chart_data
from epistand.operators.counts import counts_with_total
from epistand.operators.population import population_cells
from epistand.operators.residency import resident_by_country
from epistand.params import EPILEPSY_BANDS, EPILEPSY_CODES, LookbackParams
from epistand.plans.incidence_topics import incidence_cells, stacked_stays, topic_deaths

# The age-group names shown in the chart, per coarse band.
BAND_NAMES = {1: "<15", 2: "15-54", 3: "55+"}


@dataclass(frozen=True)
class EpilepsyParams:
    death_window: tuple = (date(1974, 1, 1), date(2023, 12, 31))
    stay_window: tuple = (date(1994, 4, 1), date(2024, 3, 31))
    population_years: tuple = (2003, 2023)
    output_after_year: int = 2002
    deaths_from_year: int = 2008
    chart_from_label: str = "2008/09"
    lookback: LookbackParams = field(default_factory=lambda: LookbackParams(gap_from="doadm"))
    bands: tuple = EPILEPSY_BANDS


def deaths(src, p: EpilepsyParams) -> DataFrame:
    return topic_deaths(src.deaths, EPILEPSY_CODES, p.death_window)


def death_chart(src, p: EpilepsyParams) -> DataFrame:
    counts = counts_with_total(deaths(src, p).withColumnRenamed("year_of_registration", "cal_year"),
                               keep_unmatched=False)
    return (counts.where(F.col("cal_year") >= p.deaths_from_year)
            .select(F.col("cal_year").alias("class2"), F.col("n").alias("measure"), F.col("sex").alias("class1")))


def incidence(src, p: EpilepsyParams) -> DataFrame:
    stays = stacked_stays(src, EPILEPSY_CODES, p.stay_window, board_filter=True)
    pop = population_cells(src.population, *p.population_years)
    return incidence_cells(stays, resident_by_country(deaths(src, p)), src.postcode_lookup, pop, p.bands,
                           p.lookback, p.output_after_year, how="full")


def incidence_chart(inc: DataFrame, p: EpilepsyParams) -> DataFrame:
    """Rates by sex (all ages) and by sex and age group, rounded to one decimal."""
    whole = chart_data(inc, 100000).select("year", "sex", F.lit("All ages").alias("agegrp"),
                                          F.concat_ws(" - ", "sex", F.lit("All ages")).alias("sex_agegrp"), "rate")
    bands = band_chart(inc, p.bands, [BAND_NAMES[b.label] for b in p.bands]).select(
        "year", "sex", F.col("band").alias("agegrp"), F.concat_ws(" ", "sex", "band").alias("sex_agegrp"), "rate")
    out = whole.unionByName(bands)
    return (out.where(F.col("year") >= p.chart_from_label)
            .select("year", "sex_agegrp", "sex", "agegrp", F.round("rate", 1).alias("rate")))


def run(src, p: EpilepsyParams = EpilepsyParams()) -> dict[str, DataFrame]:
    from epistand.sources.readers import lineage_cut
    return {"incidence_deaths_chart_1": death_chart(src, p),
            "incidence_agesex_chart_1": incidence_chart(lineage_cut(incidence(src, p)), p)}
