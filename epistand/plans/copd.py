"""COPD: mortality rates; incidence with a 10-year look-back from the previous discharge, by sex
and age group; admission rates by deprivation quintile for ages 65+."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.ages import age_band, coarse_band_from_grp, epop_weight
from epistand.functions.dates import year_label
from epistand.functions.labels import sex_label
from epistand.operators.cells import count_cells, with_denominators
from epistand.operators.charts import band_chart, chart_data, project_chart, split_charts
from epistand.operators.population import area_population_long, population_cells
from epistand.operators.residency import resident_by_country, resident_by_lookup
from epistand.operators.standardise import rates_within_bands
from epistand.params import (COPD_BANDS, COPD_DEATH_CODES, COPD_DEPRIVATION_BANDS, COPD_STAY_CODES,
                             LookbackParams)
from epistand.plans.incidence_topics import incidence_cells, stacked_stays, topic_deaths
from epistand.sources.readers import lineage_cut

# Names of the charts of the coarse bands.
BAND_CHARTS = ("copd_undersixtyfive_chart", "copd_sixtyfive_eightyfour_chart", "copd_eightyfiveplus_chart")


@dataclass(frozen=True)
class CopdParams:
    death_window: tuple = (date(2002, 1, 1), date(2024, 12, 31))
    stay_window: tuple = (date(1991, 4, 1), date(2025, 3, 31))
    population_after_year: int = 2001
    output_after_year: int = 2001
    lookback: LookbackParams = field(default_factory=lambda: LookbackParams(gap_from="dodis"))
    bands: tuple = COPD_BANDS
    event_year: int = 2023
    population_year: int = 2022
    deprivation_first_age: int = 65


def deaths(src, p: CopdParams) -> DataFrame:
    return resident_by_country(topic_deaths(src.deaths, None, p.death_window, regex_codes=COPD_DEATH_CODES))


def population(src, p: CopdParams) -> DataFrame:
    return population_cells(src.population, first_year=p.population_after_year + 1)


def mortality_cells(src, p: CopdParams) -> DataFrame:
    d = deaths(src, p).withColumn("age_grp", age_band("age"))
    counted = count_cells(d, [F.col("sex"), F.col("age_grp"), F.col("year_of_registration").alias("year")])
    return with_denominators(counted, population(src, p), how="full")


def stays(src, p: CopdParams) -> DataFrame:
    """Stays from the current and historic tables, before the residency filter."""
    return stacked_stays(src, COPD_STAY_CODES, p.stay_window)


def incidence(src, p: CopdParams, stays_df: DataFrame | None = None) -> DataFrame:
    stays_df = stays(src, p) if stays_df is None else stays_df
    return incidence_cells(stays_df, deaths(src, p), src.postcode_lookup, population(src, p), p.bands,
                           p.lookback, p.output_after_year, how="left")


def deprivation_cells(src, p: CopdParams, stays_df: DataFrame | None = None) -> DataFrame:
    """Area populations (65+) with quintiles, joined to admission counts with the population on
    the left so that areas without admissions keep their population."""
    stays_df = stays(src, p) if stays_df is None else stays_df
    adm = (stays_df.where(F.col("age") > p.deprivation_first_age - 1)
           .withColumn("age_grp", age_band("age"))
           .where(F.col("year") == p.event_year)
           .select(F.lit(p.population_year).alias("year"), "age_grp", "sex", "pc7"))
    adm = resident_by_lookup(adm, src.postcode_lookup, keep_zone=True)
    counted = count_cells(adm, ["year", "sex", "age_grp", "datazone2011"])
    dep = (src.deprivation_lookup.withColumnRenamed("datazone", "datazone2011")
           .select("datazone2011", "year", "sc_quin").where(F.col("year") == p.population_year))
    dz = area_population_long(src.population_dz, p.population_year, p.deprivation_first_age)
    dz = (dz.join(dep, on=["datazone2011", "year"], how="left")
          .groupBy("year", "sc_quin", "datazone2011", "sex", "age_grp")
          .agg(F.coalesce(F.sum("pop"), F.lit(0)).alias("pop")))
    common = [c for c in dz.columns if c in counted.columns]
    joined = dz.join(counted, on=common, how="left")
    return (joined.groupBy("year", "sex", "age_grp", "sc_quin")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("numerator"),
                 F.coalesce(F.sum("pop"), F.lit(0)).alias("denominator"))
            .withColumn("epop", epop_weight("age_grp"))
            .withColumn("age_grp2", coarse_band_from_grp("age_grp", COPD_DEPRIVATION_BANDS)))


def deprivation_chart(cells: DataFrame) -> DataFrame:
    rates = rates_within_bands(cells, COPD_DEPRIVATION_BANDS, cats=["sc_quin"])
    return rates.select("*", F.concat_ws(" ", sex_label("sex"), F.col("age_grp2")).alias("age_sex"),
                        year_label("year").alias("year_label"))


def incidence_charts(inc: DataFrame, p: CopdParams) -> DataFrame:
    """The all-ages chart and the charts of the coarse bands (one pass); ``chart`` names them."""
    whole = chart_data(inc, 100000).withColumn("chart", F.lit("all_copd_scotland_chart"))
    return whole.unionByName(band_chart(inc, p.bands, BAND_CHARTS).withColumnRenamed("band", "chart"))


def deprivation_charts(cells: DataFrame) -> dict[str, DataFrame]:
    dep = deprivation_chart(cells)
    cols = {"class1": "sc_quin", "measure": "rate", "class2": "age_sex"}
    return {"copd_deprivation_chart1": project_chart(dep, cols, F.col("age_sex").isin("Male 65-84", "Male +85")),
            "copd_deprivation_chart2": project_chart(dep, cols, F.col("age_sex").isin("Female 65-84", "Female +85"))}


def run(src, p: CopdParams = CopdParams()) -> dict[str, DataFrame]:
    """The stacked stays feed incidence and deprivation, and the incidence cells feed four charts:
    both are materialised once (reliable checkpoint) instead of recomputed per written output."""
    shared = lineage_cut(stays(src, p))
    inc = lineage_cut(incidence(src, p, shared))
    out = {"deaths_scotland": chart_data(mortality_cells(src, p), 100000, year_type="calendar")}
    out.update(split_charts(lineage_cut(incidence_charts(inc, p)), ("all_copd_scotland_chart", *BAND_CHARTS)))
    out.update(deprivation_charts(deprivation_cells(src, p, shared)))
    return out
