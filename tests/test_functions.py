import datetime as dt

from pyspark.sql import functions as F

from epistand.functions import age_band, any_position_match, code_match, epop_weight, fiscal_year, year_label
from epistand.functions.ages import coarse_band, coarse_band_from_grp
from epistand.functions.labels import sex_label
from epistand.functions.text import clean_name, parse_count
from epistand.params import ASTHMA_DEATH_CODES, COPD_BANDS, DIABETES_BANDS, DIABETES_CODES, EPOP_WEIGHTS, epop_total


def test_age_band_cases(spark):
    cases = [(0, 1), (4, 1), (5, 2), (84, 17), (85, 18), (89, 18), (90, 19), (200, 19), (201, None), (-1, None), (None, None)]
    df = spark.createDataFrame([(a,) for a, _ in cases], "age int")
    got = [r[0] for r in df.select(age_band("age")).collect()]
    assert got == [b for _, b in cases]


def test_fiscal_year_cases(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),), (dt.date(2024, 4, 1),), (dt.date(2024, 1, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(fiscal_year("d")).collect()] == [2023, 2024, 2023, None]


def test_year_labels(spark):
    df = spark.createDataFrame([(2019,), (1999,), (2009,)], "y int")
    rows = df.select(year_label("y"), year_label("y", "calendar")).collect()
    assert [tuple(r) for r in rows] == [("2019/20", "2019"), ("1999/00", "1999"), ("2009/10", "2009")]


def test_epop_weights(spark):
    assert sum(EPOP_WEIGHTS) == 100000
    df = spark.range(0, 21).select(F.col("id").cast("int").alias("g"))
    got = {r[0]: r[1] for r in df.select("g", epop_weight("g")).collect()}
    assert got[0] is None and got[20] is None
    assert [got[g] for g in range(1, 20)] == [float(w) for w in EPOP_WEIGHTS]


def test_coarse_band_totals_match_weights():
    assert [b.epop_total for b in COPD_BANDS] == [80500, 17000, 2500]
    assert [b.epop_total for b in DIABETES_BANDS] == [27500, 26500, 26500, 19500]


def test_coarse_bands_by_age_and_by_grp_agree(spark):
    df = spark.range(0, 101).select(F.col("id").cast("int").alias("age")).withColumn("g", age_band("age"))
    rows = df.select(coarse_band("age", COPD_BANDS).alias("a"), coarse_band_from_grp("g", COPD_BANDS).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_any_position_null_does_not_hide_match(spark):
    df = spark.createDataFrame([("J450", None, "E119"), ("E159", None, None), ("E101", "X", None)], "a string, b string, c string")
    got = [r[0] for r in df.select(any_position_match(["a", "b", "c"], DIABETES_CODES)).collect()]
    assert got == [True, False, True]


def test_prefix_codes(spark):
    df = spark.createDataFrame([("J450",), ("4930",), ("-493",), ("J440",), (None,)], "c string")
    got = [r[0] for r in df.select(code_match("c", ASTHMA_DEATH_CODES)).collect()]
    assert got == [True, True, True, False, None]


def test_sex_label_keeps_unmatched(spark):
    df = spark.createDataFrame([("1",), ("2",), ("9",)], "s string")
    assert [r[0] for r in df.select(sex_label("s")).collect()] == ["Male", "Female", "9"]
    assert [r[0] for r in df.select(sex_label("s", keep_unmatched=False)).collect()] == ["Male", "Female", None]


def test_parse_count(spark):
    df = spark.createDataFrame([("1,234",), ("-",), ("12",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(parse_count("v")).collect()] == [1234.0, 0.0, 12.0, None, None]


def test_clean_name():
    assert clean_name("LINKNO") == "linkno"
    assert clean_name("linkNo") == "link_no"
    assert clean_name("Date of Registration") == "date_of_registration"
    assert epop_total(range(1, 20)) == 100000
