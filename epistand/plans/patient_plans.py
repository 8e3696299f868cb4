"""Analyses on the patient-bucketed table: roll-up, first per year with residency, look-back."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.functions.codes import code_match
from epistand.operators.extract import select_codes, select_window, valid_sex
from epistand.operators.incidence import incident_events, incident_events_simple
from epistand.operators.patient_work import IS_DEATH, all_records, events_with_area, first_with_area, residents
from epistand.operators.lookback_state import LookbackState
from epistand.params import RESIDENT_COUNTRY, CodeSet, LookbackParams
from epistand.plans.incidence_topics import topic_episodes
from epistand.sources.readers import lineage_cut
from epistand.sources.patient_table import PatientTable, fingerprint, patient_table, with_area

INPUTS = ("lineitem", "orders", "customer", "nation")


def source_records(src) -> DataFrame:
    return all_records(src.episodes, src.episodes_historic, src.deaths)


def base_records(src) -> DataFrame:
    return with_area(source_records(src), src.postcode_lookup)


def layout(src, buckets: int | None = None) -> PatientTable:
    """The bucketed table of a source folder, written once for each state of its files."""
    key = fingerprint(src.spark, [os.path.join(src.sf_dir, f"{t}.parquet") for t in INPUTS], "layout-3", buckets)
    return patient_table(src.spark, source_records(src), key, buckets=buckets, lookup=src.postcode_lookup,
                         name="patients-" + os.path.basename(os.path.normpath(src.sf_dir)))


def stays(table: PatientTable, codes: CodeSet, window: tuple[date, date], board_filter: bool = False) -> DataFrame:
    """Stays of both episode tables with source rank, postcode and area."""
    return table.per_patient(lambda t: events_with_area(topic_episodes(t.where(f"not {IS_DEATH}"), codes, window, board_filter)))


def first_admissions(table: PatientTable, codes: CodeSet, window: tuple[date, date]) -> DataFrame:
    """First admission in the current table per resident patient and fiscal year."""
    def work(t):
        e = select_window(t.where("source_rank = 1"), "admission_date", *window)
        return residents(first_with_area(select_codes(valid_sex(e), "main_condition", codes)))
    return table.per_patient(work)


def death_test(codes: CodeSet, window: tuple[date, date]) -> Column:
    """Resident deaths of known sex with a matching underlying cause, registered in the window."""
    return (F.expr(IS_DEATH) & F.col("admission_date").between(*map(F.lit, window)) & (F.col("sex") != "9")
            & code_match("underlying_cause_of_death", codes) & (F.col("country_of_residence") == RESIDENT_COUNTRY))


def stay_test(codes: CodeSet, window: tuple[date, date]) -> Column:
    """Episodes of valid sex with a matching main condition, admitted in the window."""
    return (~F.expr(IS_DEATH) & F.col("admission_date").between(*map(F.lit, window)) & F.col("sex").isin("1", "2")
            & code_match("main_condition", codes))


def events(records: DataFrame, stay_codes: CodeSet, stay_window, death_codes: CodeSet, death_window) -> DataFrame:
    """Deaths and resident stays of a topic, one row each."""
    return residents(events_with_area(records.where(stay_test(stay_codes, stay_window) | death_test(death_codes, death_window))))


def incident(table: PatientTable, stay_codes: CodeSet, stay_window, death_codes: CodeSet, death_window,
             lookback: LookbackParams) -> DataFrame:
    """Incident events among a topic's deaths and resident stays.

    Light patients: a lag inside their bucket. Patients aside: the range cut of ``incident_events``."""
    options = {"gap_from": lookback.gap_from, "min_gap_years": lookback.min_gap_years, "days_per_year": lookback.days_per_year}
    topic = lambda t: events(t, stay_codes, stay_window, death_codes, death_window)
    return table.per_patient(lambda t: incident_events_simple(topic(t), **options), lambda t: incident_events(topic(t), **options))


def records_per_source(table: PatientTable) -> DataFrame:
    """Records and patients by source, patients aside included (a check of the table against its inputs)."""
    each = table.per_patient(lambda t: t.groupBy("link_no", "source_rank").agg(F.count(F.lit(1)).alias("n")))
    return each.groupBy("source_rank").agg(F.sum("n").alias("records"), F.count("link_no").alias("patients"))


def delivered_year() -> Column:
    """Year in which a record arrives: that of its discharge, one later where the day is a fifth of the month's."""
    return (F.year("dodis") + F.when(F.dayofmonth("dodis") % 5 == 0, 1).otherwise(0)).cast("int")


def yearly_lookback(events_df: DataFrame, folder: str, lookback: LookbackParams, first_year: int, keep=()):
    """The look-back re-run year by year: records that arrive up to ``first_year`` are the first batch,
    then each later year is one. Returns the state and the steps."""
    spark = events_df.sparkSession
    batches = lineage_cut(events_df.withColumn("_batch", F.greatest(delivered_year(), F.lit(first_year))))
    years = sorted(r[0] for r in batches.select("_batch").distinct().collect() if r[0] is not None)
    state = LookbackState(spark, folder, lookback, keep)
    return state, [state.advance(batches.where(F.col("_batch") == y).drop("_batch"), str(y)) for y in years]
