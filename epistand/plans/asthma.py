"""Asthma: death counts with a both-sex total; first admission per patient-year -> rates by sex,
both sexes, under 10 and 10+."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.ages import age_band, coarse_band
from epistand.operators.cells import count_cells, with_denominators
from epistand.operators.charts import band_chart, chart_data, split_charts
from epistand.operators.counts import counts_with_total
from epistand.operators.extract import first_per_patient_year, select_codes, select_window, valid_sex
from epistand.operators.population import population_cells
from epistand.operators.residency import resident_by_lookup
from epistand.params import ASTHMA_BANDS, ASTHMA_DEATH_CODES, ASTHMA_STAY_CODES

# Names of the charts of the coarse bands.
BAND_CHARTS = ("underten_chart", "tenplus_chart")


@dataclass(frozen=True)
class AsthmaParams:
    death_years: tuple = (2002, 2021)
    stay_window: tuple = (date(2002, 4, 1), date(2022, 3, 31))
    population_years: tuple = (2002, 2021)
    bands: tuple = ASTHMA_BANDS


def death_counts(src, p: AsthmaParams) -> DataFrame:
    d = src.deaths.where(F.col("year_of_registration").between(*p.death_years))
    d = select_codes(d, "underlying_cause_of_death", ASTHMA_DEATH_CODES)
    return counts_with_total(d.withColumnRenamed("year_of_registration", "cal_year"))


def admissions(src, p: AsthmaParams) -> DataFrame:
    """First admission per patient and fiscal year, banded, residents only."""
    e = select_window(src.episodes, "admission_date", *p.stay_window)
    e = select_codes(valid_sex(e), "main_condition", ASTHMA_STAY_CODES)
    first = first_per_patient_year(e)
    first = first.withColumns({"age_grp": age_band("age"), "age_grp2": coarse_band("age", p.bands)})
    return resident_by_lookup(first, src.postcode_lookup)


def cells(src, p: AsthmaParams) -> DataFrame:
    pop = population_cells(src.population, *p.population_years)
    counted = count_cells(admissions(src, p), ["age_grp", "age_grp2", "sex", "year"])
    return with_denominators(counted, pop, how="full")


def band_charts(cells_df: DataFrame, bands) -> DataFrame:
    """The charts of both coarse bands in one frame; ``chart`` names the chart of each row."""
    return band_chart(cells_df, bands, BAND_CHARTS).withColumnRenamed("band", "chart")


def summary_chart(spark, path: str) -> DataFrame:
    """An earlier chart file (class1, class2, measure) with '', ' ' and 'NA' as missing, measure
    rounded to one decimal: the data behind the publication summary chart."""
    from epistand.sources.readers import read_csv_na
    from epistand.sources.schemas import CHART_CSV
    chart = read_csv_na(spark, path, CHART_CSV)
    return chart.select("class1", "class2", F.round("measure", 1).alias("measure"))


def run(src, p: AsthmaParams = AsthmaParams()) -> dict[str, DataFrame]:
    """The cells (a few hundred rows) feed four charts: materialised once."""
    from epistand.sources.readers import lineage_cut
    c = lineage_cut(cells(src, p))
    out = {
        "deaths_chart": death_counts(src, p),
        "sex_chart": chart_data(c, 100000),
        "all_chart": chart_data(c, 200000, by_sex=False),
    }
    out.update(split_charts(lineage_cut(band_charts(c, p.bands)), BAND_CHARTS))
    return out
