"""Shared steps of the topics that measure incidence with a look-back (COPD, epilepsy, MS):
stays from the current and historic tables, residents only, stacked with deaths, banded, and
reduced to incident events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.functions.ages import age_band, coarse_band
from epistand.operators.cells import count_cells, with_denominators
from epistand.operators.extract import death_events, select_codes, select_window, stack_episodes, stay_rollup, valid_sex
from epistand.operators.incidence import incident_events
from epistand.operators.residency import resident_by_lookup, treated_in_board


def topic_episodes(episodes: DataFrame, codes, window, board_filter: bool) -> DataFrame:
    e = select_window(episodes, "admission_date", *window)
    if board_filter:
        e = treated_in_board(e)
    return select_codes(valid_sex(e), "main_condition", codes)


def stacked_stays(src, codes, window, board_filter: bool = False) -> DataFrame:
    """Stays of each source table: the selected episodes are stacked first, so one roll-up (one
    exchange) serves both tables."""
    e = stack_episodes(topic_episodes(src.episodes, codes, window, board_filter),
                       topic_episodes(src.episodes_historic, codes, window, board_filter))
    return stay_rollup(e, by=["source_rank"])


def topic_deaths(deaths: DataFrame, codes, window, regex_codes=None) -> DataFrame:
    d = select_window(deaths, "date_of_registration", *window).where(F.col("sex") != "9")
    return select_codes(d, "underlying_cause_of_death", regex_codes or codes)


def incidence_cells(stays: DataFrame, deaths: DataFrame, lookup: DataFrame, population: DataFrame,
                    bands, lookback, output_after_year: int, how: str) -> DataFrame:
    resident = resident_by_lookup(stays, lookup)
    events = death_events(deaths).unionByName(resident, allowMissingColumns=True)
    events = events.withColumns({"age_grp": age_band("age"), "age_grp2": coarse_band("age", bands)})
    incident = incident_events(events, gap_from=lookback.gap_from, min_gap_years=lookback.min_gap_years,
                               days_per_year=lookback.days_per_year)
    incident = incident.where(F.col("year") > output_after_year)
    counted = count_cells(incident, ["age_grp", "age_grp2", "sex", "year"])
    return with_denominators(counted, population, how=how)
