"""Spark catalogue vs DuckDB oracle on the smallest scale factor (the driver runs all at sf0.01)."""

import os

import duckdb
import pytest

from epistand.plans.catalogue import queries
from epistand.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"
KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    c = duckdb.connect()
    for t in ("nation", "customer", "orders", "lineitem"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 4) if isinstance(r[i], float) else (r[i].isoformat() if hasattr(r[i], "isoformat") else r[i])
                         for i in order))
    return sorted(out, key=repr)


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    sdf = queries()[key](spark, SF)
    res = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in sdf.collect()], sdf.columns) == _norm(res.fetchall(), dcols)


SURVEY_KEYS = [
    "fiscal_year_counts", "age_bands", "epop_weights", "coarse_bands", "year_labels", "code_prefix_match",
    "code_regex_match", "code_any_position", "stay_rollup", "stay_condition_flags", "first_per_patient_year",
    "residency_semi", "residency_inner", "residency_columns", "population_cells", "cells_full_join",
    "cells_left_join", "rates_by_sex", "rates_with_cats", "rates_both_sex_standardised", "rates_both_sex_pooled",
    "rates_coarse_collapsed", "rates_coarse_standardised", "counts_grouping_sets", "death_counts_conditional",
    "lookback_from_discharge", "lookback_from_admission", "deprivation_rates", "wide_age_unpivot",
    "locf_fill_down", "drop_empty_and_parse", "top_causes_under75", "top_causes_all_ages", "chart_projection",
    "two_level_aggregation", "union_by_name",
]


def test_survey_catalogue_keys_registered_with_oracle():
    q, o = queries(), oracle_sql()
    missing = [k for k in SURVEY_KEYS if k not in q or k not in o]
    assert not missing
