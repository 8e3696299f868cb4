"""Allergic conditions: twelve condition flags per stay, a multi-condition total, and
sex-standardised rates by condition for both sexes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.ages import age_band, epop_weight
from epistand.functions.codes import code_match
from epistand.functions.dates import year_label
from epistand.functions.labels import recode
from epistand.operators.cells import null_safe_join
from epistand.operators.extract import select_codes, select_window, stay_flags, valid_sex
from epistand.operators.population import population_cells
from epistand.operators.residency import treated_in_board
from epistand.operators.standardise import standardised_rates
from epistand.params import ALLERGY_FLAGS, ALLERGY_LABELS, ALLERGY_SELECTION, ALLERGY_TOTAL_FLAGS

FLAG_NAMES = [name for name, _ in ALLERGY_FLAGS]


@dataclass(frozen=True)
class AllergyParams:
    discharge_window: tuple = (date(2008, 4, 1), date(2023, 3, 31))
    population_years: tuple = (2008, 2022)


def stays(src, p: AllergyParams) -> DataFrame:
    e = select_window(src.episodes, "discharge_date", *p.discharge_window)
    e = select_codes(valid_sex(treated_in_board(e)), "main_condition", ALLERGY_SELECTION)
    flags = {name: code_match("main_condition", cs) for name, cs in ALLERGY_FLAGS}
    return stay_flags(e, flags, year_from="discharge_date")


def with_total(df: DataFrame) -> DataFrame:
    """Row sum over the first ten condition flags (a stay counts once per condition)."""
    return df.withColumn("total", sum((F.col(c) for c in ALLERGY_TOTAL_FLAGS), F.lit(0)))


def cells(src, p: AllergyParams) -> DataFrame:
    s = stays(src, p).withColumn("age_grp", age_band("age"))
    counted = with_total(s.groupBy("age_grp", "sex", "year")
                         .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FLAG_NAMES]))
    pop = population_cells(src.population, *p.population_years)
    joined = null_safe_join(counted, pop, ["year", "age_grp", "sex"], "full").withColumnRenamed("pop", "denominator")
    long = joined.unpivot(["age_grp", "sex", "year", "denominator"], FLAG_NAMES + ["total"], "type", "numerator")
    return long.withColumn("epop", epop_weight("age_grp"))


def rates(cells_df: DataFrame) -> DataFrame:
    """Both sexes standardised together (total 200000) per condition and year."""
    return standardised_rates(cells_df, 200000, by_sex=False, cats=["type"])


def chart(rates_df: DataFrame) -> DataFrame:
    return rates_df.select(year_label("year").alias("year"), recode("type", ALLERGY_LABELS).alias("type"),
                           "numerator", "rate")


def run(src, p: AllergyParams = AllergyParams()) -> dict[str, DataFrame]:
    return {"scotland_chart": chart(rates(cells(src, p)))}
