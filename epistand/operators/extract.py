"""Record selection and roll-ups of hospital episodes (one row per stay or per patient-year)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.functions.codes import code_match
from epistand.functions.dates import fiscal_year
from epistand.params import CodeSet, VALID_SEXES

OTHER_CONDITIONS = [f"other_condition_{i}" for i in range(1, 6)]
DEATH_CODES = [f"cause_of_death_code_{i}" for i in range(10)]

# Tie-break rank of each source in a patient's history: deaths sort before stays on the same day.
SOURCE_RANK = {"deaths": 0, "current": 1, "historic": 2}


def select_codes(df: DataFrame, code_col: str, codes: CodeSet) -> DataFrame:
    """Keep rows whose code matches."""
    return df.where(code_match(code_col, codes))


def select_window(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Inclusive date window (pushed down to the Parquet scan as two comparisons)."""
    return df.where(F.col(date_col).between(F.lit(start), F.lit(end)))


def valid_sex(df: DataFrame, col: str = "sex") -> DataFrame:
    return df.where(F.col(col).isin(list(VALID_SEXES)))


def stay_rollup(episodes: DataFrame, year_from: str = "admission_date", by=()) -> DataFrame:
    """One row per continuous inpatient stay (link_no, cis_marker): oldest age, first admission,
    last discharge, max sex, min postcode and max fiscal year. ``by`` names further keys, such as the
    source of stacked tables.

    Grouping on both keys spreads a patient's stays over tasks; partial aggregation runs before
    the shuffle, so one very long stay does not concentrate rows either."""
    return (
        episodes.groupBy(F.col("link_no").alias("linkno"), F.col("cis_marker").alias("cis"), *by)
        .agg(
            F.max("age_in_years").alias("age"),
            F.min("admission_date").alias("doadm"),
            F.max("discharge_date").alias("dodis"),
            F.max("sex").alias("sex"),
            F.min("dr_postcode").alias("pc7"),
            F.max(fiscal_year(year_from)).alias("year"),
        )
    )


def stay_flags(episodes: DataFrame, flags: dict[str, Column], year_from: str = "discharge_date",
               keep_stay_dates: bool = False) -> DataFrame:
    """One row per stay with ``max(case when <predicate> then 1 else 0 end)`` per named flag.

    The sex must be a one-digit code (see ``valid_sex``): it is aggregated as a number, so that Spark
    can hash-aggregate instead of sorting."""
    aggs = [
        F.max("age_in_years").alias("age"),
        F.max(F.col("sex").cast("tinyint")).cast("string").alias("sex"),
        F.max(fiscal_year(year_from)).alias("year"),
    ]
    if keep_stay_dates:
        aggs += [F.min("admission_date").alias("doadm"), F.max("discharge_date").alias("dodis")]
    aggs += [F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0))).alias(name) for name, pred in flags.items()]
    return episodes.groupBy(F.col("link_no").alias("linkno"), F.col("cis_marker").alias("cis")).agg(*aggs)


def first_per_patient_year(episodes: DataFrame, date_col: str = "admission_date") -> DataFrame:
    """One row per (patient, fiscal year): min age, min sex, min postcode."""
    return (
        episodes.groupBy(F.col("link_no").alias("linkno"), fiscal_year(date_col).alias("year"))
        .agg(F.min("age_in_years").alias("age"), F.min("sex").alias("sex"),
             F.min("dr_postcode").alias("pc7"))
    )


def stack_episodes(current: DataFrame, historic: DataFrame) -> DataFrame:
    """Selected episodes of the current and historic tables, stacked (duplicates kept) with a
    source rank used to break same-day ties later."""
    return (current.withColumn("source_rank", F.lit(SOURCE_RANK["current"]))
            .unionByName(historic.withColumn("source_rank", F.lit(SOURCE_RANK["historic"]))))


def death_events(deaths: DataFrame) -> DataFrame:
    """Deaths shaped as events: registration date is both admission and discharge date."""
    return deaths.select(
        F.col("link_no").alias("linkno"),
        F.col("year_of_registration").alias("cal_year"),
        F.col("underlying_cause_of_death").alias("cod"),
        F.col("age"), F.col("sex"),
        F.col("date_of_registration").alias("doadm"),
        F.col("date_of_registration").alias("dodis"),
        F.col("country_of_residence"),
        fiscal_year("date_of_registration").alias("year"),
        F.lit(SOURCE_RANK["deaths"]).alias("source_rank"),
    )
