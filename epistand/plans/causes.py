"""Causes of death: a published table (two sections of text lines per release) -> cleaned long
counts -> the ten largest causes as a share of all deaths, under 75 and at all ages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from epistand.operators.reshape import clean_published_counts, fill_down, read_sections
from epistand.operators.topcauses import top_causes
from epistand.params import ALL_AGES_COLUMN, UNDER75_EXCLUDED_AGES
from epistand.sources.schemas import VITAL_EVENTS_COLUMNS

ID_COLUMNS = VITAL_EVENTS_COLUMNS[:3]
COUNT_COLUMNS = VITAL_EVENTS_COLUMNS[3:]


@dataclass(frozen=True)
class CausesParams:
    # (skip, n_max) of each section; empty rows are removed from the first section only.
    section1: tuple = (7, 70)
    section2: tuple = (83, 69)


def table(lines: DataFrame, p: CausesParams) -> DataFrame:
    return read_sections(lines, [(*p.section1, True), (*p.section2, False)], VITAL_EVENTS_COLUMNS)


def clean(lines: DataFrame, p: CausesParams, fill=fill_down) -> DataFrame:
    return clean_published_counts(table(lines, p), ID_COLUMNS, COUNT_COLUMNS, fill=fill)


def run(lines: DataFrame, p: CausesParams = CausesParams()) -> dict[str, DataFrame]:
    c = clean(lines, p)
    return {"top10causes_chart2": top_causes(c, exclude_ages=UNDER75_EXCLUDED_AGES),
            "top10causes_chart1": top_causes(c, ages=[ALL_AGES_COLUMN])}
