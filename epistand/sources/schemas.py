"""Explicit schemas of the input tables (no inference) and a boundary check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EPISODES = _struct(
    ("link_no", S), ("cis_marker", S), ("age_in_years", I), ("sex", S), ("dr_postcode", S),
    ("admission_date", D), ("discharge_date", D), ("hbtreat_currentdate", S), ("main_condition", S),
    *[(f"other_condition_{i}", S) for i in range(1, 6)],
)
DEATHS = _struct(
    ("link_no", S), ("year_of_registration", I), ("date_of_registration", D), ("age", I), ("sex", S),
    ("country_of_residence", S), ("underlying_cause_of_death", S),
    *[(f"cause_of_death_code_{i}", S) for i in range(10)],
)
POPULATION = _struct(("year", I), ("age", I), ("sex", S), ("pop", L))
POPULATION_CA = _struct(("code", S), ("year", I), ("sex_grp", S), ("age_grp", I), ("denominator", L))
POSTCODE_LOOKUP = _struct(("pc7", S), ("datazone2011", S))
DEPRIVATION_LOOKUP = _struct(("datazone", S), ("year", I), ("sc_quin", I))
POPULATION_DZ = _struct(("year", I), ("datazone2011", S), ("sex", S),
                        *[(f"age{a}", L) for a in range(65, 90)], ("age90plus", L))
VITAL_EVENTS_COLUMNS = ["ICD_10_code", "cause_of_death", "sex", "all_ages", "<4_weeks", "4-52_weeks",
                        "1-4", "5-9", "10-14", "15-24", "25-34", "35-44", "45-54", "55-64", "65-74",
                        "75-84", "85-89", "90+"]
CHART_CSV = _struct(("class1", S), ("class2", S), ("measure", T.DoubleType()))


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise if a column is missing or has another type; return the columns in schema order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError("schema mismatch: " + "; ".join(problems))
    return df.select(*[f.name for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns with its types (missing columns become typed NULLs)."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
