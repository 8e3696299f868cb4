"""Guards of joins, readers and rates."""

import pytest
from pyspark.errors import PySparkException

from epistand.operators.cells import without_denominator
from epistand.operators.reshape import read_sections
from epistand.operators.residency import resident_by_lookup
from epistand.plans import epilepsy
from epistand.plans.catalogue import T_COPD, queries
from epistand.plans.incidence_topics import stacked_stays
from epistand.params import COPD_STAY_CODES
from epistand.sources.readers import read_warehouse
from epistand.sources.testdata import Sources

SF = "/root/testdata/sf0.001"


def test_repeated_postcode_stops_the_zone_join(spark):
    stays = spark.createDataFrame([(1, "a"), (2, "b")], "id int, pc7 string")
    lookup = spark.createDataFrame([("a", "z1"), ("a", "z1"), ("b", "z2"), ("c", None)], "pc7 string, datazone2011 string")
    assert resident_by_lookup(stays, lookup).count() == 2
    with pytest.raises(PySparkException, match="more than once"):
        resident_by_lookup(stays, lookup, keep_zone=True).collect()
    once = lookup.distinct()
    assert {(r.id, r.datazone2011) for r in resident_by_lookup(stays, once, keep_zone=True).collect()} == {(1, "z1"), (2, "z2")}


def test_cells_without_denominator_are_counted(spark):
    cells = spark.createDataFrame([(2000, 3, None), (2000, 4, 0), (2000, 5, 10), (2001, 1, 7)], "year int, numerator long, denominator long")
    assert [tuple(r) for r in without_denominator(cells).collect()] == [(2000, 2, 7)]


def test_sections_read_na_and_the_first_fields_only(spark):
    lines = spark.createDataFrame([("r", 1, 'A,"x",1,later'), ("r", 2, "NA, ,NA,note"), ("r", 3, ',"",'), ("r", 4, "B,NA,2"), ("r", 5, "NAB,,")],
                                  "release string, line_no int, value string")
    got = read_sections(lines, [(0, 5, True)], ["code", "name", "n"]).orderBy("line_no").collect()
    assert [tuple(r)[1:] for r in got] == [(1, "A", "x", "1"), (4, "B", None, "2"), (5, "NAB", None, None)]


def test_warehouse_reader_needs_slices(spark):
    with pytest.raises(ValueError):
        read_warehouse(spark, "jdbc:none", "select 1", {}, predicates=[])


def test_building_sources_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    src = Sources(spark, SF)
    frame = stacked_stays(src, COPD_STAY_CODES, T_COPD.stay_window)
    assert src.episodes is src.episodes and not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_band_charts_have_no_filter_per_band(spark):
    for key in ("asthma_band_charts", "epilepsy_incidence_chart", "ms_incidence_charts", "copd_incidence_charts"):
        plan = queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "age_grp2" in line and " = " in line]


def test_null_ages_and_people_beyond_the_bands(spark):
    from epistand.functions.ages import age_band, coarse_band
    got = spark.createDataFrame([(None,), (99,), (130,), (201,), (-1,)], "age int").select(
        age_band("age").alias("g"), coarse_band("age", epilepsy.EpilepsyParams().bands).alias("b")).collect()
    assert [r.g for r in got] == [None, 19, 19, None, None] and got[0].b is None
