import pytest
from pyspark.sql import functions as F

from epistand.operators.standardise import collapse_bands, pooled_both_sexes, rates_within_bands, standardised_rates
from epistand.params import CoarseBand

CELLS = "year int, age_grp int, age_grp2 int, sex string, numerator long, denominator long, epop double"
BAND1 = (CoarseBand(1, None, 9, 1, 2),)


def _rate(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_standardised_rate(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0), (2020, 2, 1, "1", 5, 250, 5500.0)], CELLS)
    r = _rate(standardised_rates(c, 100000))
    assert r.numerator == 15 and r.rate == pytest.approx(160.0)


def test_within_band(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0), (2020, 2, 1, "1", 5, 250, 5500.0)], CELLS)
    r = _rate(rates_within_bands(c, (CoarseBand(1, None, 9, 1, 2),)))
    assert r.rate == pytest.approx(1523.8095, abs=1e-3)


def test_collapsed_band_is_crude_rate(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0), (2020, 2, 1, "1", 5, 250, 5500.0)], CELLS)
    r = _rate(standardised_rates(collapse_bands(c), 10500))
    assert r.rate == pytest.approx(1200.0)


def test_zero_event_cell_drops_out_of_collapsed_band(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0), (2020, 2, None, "1", 0, 250, 5500.0)], CELLS)
    collapsed = collapse_bands(c).where(F.col("age_grp") == 1)
    assert _rate(standardised_rates(collapsed, 10500)).rate == pytest.approx(476.19, abs=1e-2)
    all_cells = collapse_bands(c, bands=BAND1).where(F.col("age_grp") == 1)
    assert _rate(standardised_rates(all_cells, 10500)).rate == pytest.approx(800.0)


def test_both_sexes_three_ways(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0), (2020, 1, 1, "2", 2, 500, 5000.0)], CELLS)
    assert _rate(standardised_rates(c, 200000, by_sex=False)).rate == pytest.approx(35.0)
    pooled = pooled_both_sexes(c, keys=("year", "age_grp", "age_grp2"))
    r = _rate(standardised_rates(pooled, 200000))
    assert r.rate == pytest.approx(40.0) and r.sex == "All" and r.numerator == 12


@pytest.mark.parametrize("den", [None, 0])
def test_missing_or_zero_denominator(spark, den):
    c = spark.createDataFrame([(2020, 1, 1, "1", 3, den, 5000.0)], CELLS)
    r = _rate(standardised_rates(c, 100000))
    assert r.numerator == 3 and r.rate == 0.0


def test_duplicate_category_keys_collapse(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0)], CELLS)
    out = standardised_rates(c, 100000, cats=["sex", "year"])
    assert out.columns == ["sex", "year", "numerator", "rate"]


def test_rate_invariant_to_scaling_and_partitioning(spark):
    rows = [(2020, g, 1, s, g * 3, 1000 + g, 5000.0) for g in range(1, 20) for s in ("1", "2")]
    c = spark.createDataFrame(rows, CELLS)
    base = {(r.year, r.sex): r.rate for r in standardised_rates(c, 100000).collect()}
    scaled = c.withColumns({"numerator": F.col("numerator") * 7, "denominator": F.col("denominator") * 7})
    again = {(r.year, r.sex): r.rate for r in standardised_rates(scaled.repartition(5), 100000).collect()}
    assert base.keys() == again.keys()
    assert all(base[k] == pytest.approx(again[k]) for k in base)
    per_sex = sum(r.numerator for r in standardised_rates(c, 100000).collect())
    assert per_sex == _rate(standardised_rates(c, 200000, by_sex=False)).numerator


def test_collapse_sums_numeric_columns_by_type(spark):
    c = spark.createDataFrame([(2020, 1, 1, "1", 10, 1000, 5000.0), (2020, 2, 1, "1", 5, 250, 5500.0)], CELLS)
    out = collapse_bands(c, sum_cols=None).collect()[0]
    assert (out.numerator, out.denominator, out.epop) == (15, 1250, 10500.0)
