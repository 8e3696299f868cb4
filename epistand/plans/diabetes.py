"""Diabetes: admissions (any-position code match, stay roll-up, two-level aggregation) and
deaths (underlying vs contributory), rates by type, sex and age group."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.ages import age_band, coarse_band_from_grp, epop_weight
from epistand.functions.codes import any_position_match, code_match
from epistand.functions.dates import year_label
from epistand.operators.cells import null_safe_join
from epistand.operators.charts import label_from_keys
from epistand.operators.extract import DEATH_CODES, OTHER_CONDITIONS, select_window, stay_flags, valid_sex
from epistand.operators.residency import resident_by_country, treated_in_board
from epistand.operators.standardise import pooled_both_sexes, rates_within_bands, standardised_rates
from epistand.params import DIABETES_BANDS, DIABETES_CODES, DIABETES_KETO_CODES, SCOTLAND_CODE

# Chart labels.
CHART1_LABELS = {
    ("diab_main", "All"): "All - main diagnosis", ("diab_main", "2"): "Female - main diagnosis",
    ("diab_main", "1"): "Male - main diagnosis", ("diabetes", "All"): "All - any diagnosis",
    ("diabetes", "2"): "Female - any diagnosis", ("diabetes", "1"): "Male - any diagnosis",
}
CHART2_LABELS = {
    ("All", "2"): "Female - all ages", ("<25", "2"): "Female - 0-24", ("25-44", "2"): "Female - 25-44",
    ("45-64", "2"): "Female - 45-64", ("65+", "2"): "Female - 65+", ("All", "1"): "Male - all ages",
    ("<25", "1"): "Male - 0-24", ("25-44", "1"): "Male - 25-44", ("45-64", "1"): "Male - 45-64",
    ("65+", "1"): "Male - 65+",
}
MORTALITY_LABELS = {
    ("main_diag", "All"): "All - underlying", ("main_diag", "2"): "Female - underlying",
    ("main_diag", "1"): "Male - underlying", ("all_diag", "All"): "All - contributory",
    ("all_diag", "2"): "Female - contributory", ("all_diag", "1"): "Male - contributory",
}
ADMISSION_TYPES = ["diabetes", "diab_main", "diab_keto"]


@dataclass(frozen=True)
class DiabetesParams:
    discharge_window: tuple = (date(2011, 4, 1), date(2022, 3, 31))
    death_years: tuple = (2011, 2021)
    population_code: str = SCOTLAND_CODE
    bands: tuple = DIABETES_BANDS


def population(src, p: DiabetesParams) -> DataFrame:
    pop = src.population_ca.where(F.col("code") == p.population_code)
    pop = pop.withColumns({"epop": epop_weight("age_grp"),
                           "age_grp2": coarse_band_from_grp("age_grp", p.bands),
                           "sex": F.col("sex_grp").cast("string")})
    return (pop.groupBy("year", "sex", "age_grp", "age_grp2")
            .agg(F.coalesce(F.sum("denominator"), F.lit(0)).alias("denominator"),
                 F.coalesce(F.sum("epop"), F.lit(0.0)).alias("epop")))


def admission_stays(src, p: DiabetesParams) -> DataFrame:
    codes = ["main_condition", *OTHER_CONDITIONS]
    e = select_window(src.episodes, "discharge_date", *p.discharge_window)
    e = valid_sex(treated_in_board(e, excluded_prefix=None))
    e = e.where(any_position_match(codes, DIABETES_CODES))
    return stay_flags(e, {
        "diab_main": code_match("main_condition", DIABETES_CODES),
        "diab_keto": code_match("main_condition", DIABETES_KETO_CODES),
        "diabetes": any_position_match(codes, DIABETES_CODES),
    }, year_from="discharge_date")


def admissions_by_age(src, p: DiabetesParams) -> DataFrame:
    """Second level of the two-level aggregation: stays summed by (year, age, sex)."""
    stays = admission_stays(src, p)
    return stays.groupBy("year", "age", "sex").agg(*[F.sum(t).alias(t) for t in ("diab_main", "diab_keto", "diabetes")])


def admission_cells(src, p: DiabetesParams) -> DataFrame:
    by_age = admissions_by_age(src, p)
    cells = (by_age.withColumn("age_grp", age_band("age"))
             .withColumn("age_grp2", coarse_band_from_grp("age_grp", p.bands))
             .groupBy("year", "sex", "age_grp", "age_grp2")
             .agg(*[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in ADMISSION_TYPES]))
    long = cells.unpivot(["year", "sex", "age_grp", "age_grp2"], ADMISSION_TYPES, "type", "numerator")
    joined = null_safe_join(long, population(src, p), ["year", "sex", "age_grp", "age_grp2"], "left")
    return joined.withColumn("epop", epop_weight("age_grp"))


def chart1(adm: DataFrame) -> DataFrame:
    total = standardised_rates(pooled_both_sexes(adm), 200000, cats=["type"])
    by_sex = standardised_rates(adm, 100000, cats=["type"])
    both = total.unionByName(by_sex).where(F.col("type") != "diab_keto")
    return both.select(year_label("year").alias("class2"),
                       label_from_keys(CHART1_LABELS, ["type", "sex"]).alias("class1"),
                       "numerator", "rate")


def chart2(adm: DataFrame, p: DiabetesParams) -> DataFrame:
    keto = adm.where(F.col("type") == "diab_keto")
    bands = rates_within_bands(keto, p.bands)
    all_ages = (standardised_rates(keto, 100000, cats=["type"]).drop("type")
                .withColumn("age_grp2", F.lit("All")))
    both = bands.unionByName(all_ages)
    return both.select(year_label("year").alias("class2"),
                       label_from_keys(CHART2_LABELS, ["age_grp2", "sex"]).alias("class1"),
                       "numerator", "rate")


def deaths_by_age(src, p: DiabetesParams) -> DataFrame:
    """Deaths with diabetes in any position: count(*) and a conditional count of underlying."""
    codes = ["underlying_cause_of_death", *DEATH_CODES]
    d = src.deaths.where(F.col("year_of_registration").between(*p.death_years))
    d = resident_by_country(d).where(F.col("sex") != "9")
    d = d.where(any_position_match(codes, DIABETES_CODES))
    return (d.groupBy(F.col("year_of_registration").alias("year"), "sex", "age")
            .agg(F.count(F.lit(1)).alias("all_diag"),
                 F.count_if(code_match("underlying_cause_of_death", DIABETES_CODES)).alias("main_diag")))


def death_counts_long(src, p: DiabetesParams) -> DataFrame:
    return deaths_by_age(src, p).unpivot(["year", "sex", "age"], ["all_diag", "main_diag"], "type", "numerator")


def death_cells(src, p: DiabetesParams) -> DataFrame:
    by_age = deaths_by_age(src, p)
    cells = (by_age.withColumn("age_grp", age_band("age")).groupBy("year", "sex", "age_grp")
             .agg(*[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in ("all_diag", "main_diag")]))
    long = cells.unpivot(["year", "sex", "age_grp"], ["all_diag", "main_diag"], "type", "numerator")
    return null_safe_join(long, population(src, p), ["year", "sex", "age_grp"], "left")


def mortality_chart(cells: DataFrame) -> DataFrame:
    totals = standardised_rates(pooled_both_sexes(cells), 200000, cats=["type", "sex"])
    by_sex = standardised_rates(cells, 100000, cats=["type", "sex"])
    both = by_sex.unionByName(totals)
    return both.select(F.col("year").alias("class2"),
                       label_from_keys(MORTALITY_LABELS, ["type", "sex"]).alias("class1"),
                       "numerator", "rate")


def run(src, p: DiabetesParams = DiabetesParams(), base_path: str | None = None) -> dict[str, DataFrame]:
    """The admissions base table is materialised once (Parquet at ``base_path`` in the shared
    folder, or a reliable checkpoint) and feeds both admission charts."""
    from epistand.sources.readers import lineage_cut
    adm = lineage_cut(admission_cells(src, p), base_path)
    return {"secondarycare_chart1": chart1(adm), "secondarycare_chart2": chart2(adm, p),
            "mortality_chart1": mortality_chart(death_cells(src, p))}
