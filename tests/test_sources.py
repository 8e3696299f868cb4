import os
import tempfile

import pytest
from pyspark.sql import functions as F

from epistand.plans import asthma
from epistand.plans.catalogue import queries
from epistand.sources import schemas, testdata
from epistand.sources.readers import clean_names, lineage_cut, read_table, text_lines
from epistand.sources.sinks import write_chart_csv, write_table
from epistand.sources.testdata import Sources

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="epistand-test-", dir="/tmp")


def test_csv_with_several_na_tokens_and_rounding(spark):
    d = _tmp()
    with open(os.path.join(d, "chart.csv"), "w") as f:
        f.write("class1,class2,measure\nMale,2019/20,12.345\nNA,2020/21, \nFemale,,2.25\n")
    rows = asthma.summary_chart(spark, d).collect()
    assert [tuple(r) for r in rows] == [("Male", "2019/20", 12.3), (None, "2020/21", None), ("Female", None, 2.3)]


def test_text_lines_from_files(spark):
    d = _tmp()
    for name, body in (("a.csv", "x\ny\nz"), ("b.csv", "1\n2")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    got = sorted((os.path.basename(r.release), r.line_no, r.value) for r in text_lines(spark, d).collect())
    assert got == [("a.csv", 1, "x"), ("a.csv", 2, "y"), ("a.csv", 3, "z"), ("b.csv", 1, "1"), ("b.csv", 2, "2")]


def test_sinks_and_lineage_cut(spark):
    d = _tmp()
    df = spark.createDataFrame([(2001, "Male", 1.5), (2000, "Female", None)], "year int, sex string, rate double")
    write_chart_csv(df, os.path.join(d, "chart"), order_by=["year"])
    back = spark.read.option("header", True).csv(os.path.join(d, "chart")).collect()
    assert [tuple(r) for r in back] == [("2000", "Female", "NA"), ("2001", "Male", "1.5")]
    write_table(df, os.path.join(d, "table"))
    assert read_table(spark, os.path.join(d, "table")).count() == 2
    cut = lineage_cut(df.withColumn("x", F.col("rate") * 2))
    assert cut.count() == 2
    again = lineage_cut(df, os.path.join(d, "base"))
    assert sorted(again.columns) == sorted(df.columns)


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], "LINKNO int, `Date Of Registration` int")
    assert clean_names(df).columns == ["linkno", "date_of_registration"]


@pytest.mark.parametrize("name,schema", [("episodes", schemas.EPISODES), ("episodes_historic", schemas.EPISODES),
                                         ("deaths", schemas.DEATHS), ("population", schemas.POPULATION),
                                         ("population_ca", schemas.POPULATION_CA),
                                         ("postcode_lookup", schemas.POSTCODE_LOOKUP),
                                         ("deprivation_lookup", schemas.DEPRIVATION_LOOKUP),
                                         ("population_dz", schemas.POPULATION_DZ)])
def test_adapters_match_schemas(spark, name, schema):
    schemas.validate(getattr(Sources(spark, SF), name), schema)


def test_validate_reports_mismatch(spark):
    df = spark.createDataFrame([(1,)], "pc7 int")
    with pytest.raises(ValueError):
        schemas.validate(df, schemas.POSTCODE_LOOKUP)


def test_postcode_lookup_key_is_unique(spark):
    from epistand.operators.residency import distinct_key_violations
    assert distinct_key_violations(testdata.postcode_lookup(spark, SF)).count() == 0


BAD_NODES = ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_catalogue_plan_funnels_into_one_task_or_pairs_rows(spark):
    for name, fn in sorted(queries().items()):
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in BAD_NODES:
            assert bad not in plan, (name, bad)


def test_date_window_reaches_the_scan(spark):
    q = queries()["first_per_patient_year"](spark, SF)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan or "GreaterThanOrEqual(o_orderdate" in plan
