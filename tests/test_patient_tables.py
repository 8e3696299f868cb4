"""The patient-bucketed layout: no exchange by patient, hot patients kept aside, reuse by input state."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from epistand.operators.extract import death_events, first_per_patient_year
from epistand.operators.incidence import incident_events_simple
from epistand.operators.residency import resident_by_lookup
from epistand.params import ASTHMA_STAY_CODES, COPD_DEATH_CODES, COPD_STAY_CODES
from epistand.plans import copd, patient_plans
from epistand.plans.catalogue import LOOKBACK_COLUMNS, T_ASTHMA, T_COPD, queries
from epistand.plans.incidence_topics import stacked_stays
from epistand.sources.patient_table import PatientTable, _with_area_inside, fingerprint, patient_table
from epistand.sources.testdata import Sources

SF = "/root/testdata/sf0.001"


@pytest.fixture
def fresh():
    return f"test-{uuid.uuid4().hex}"  # a checkpoint folder may outlive a test run


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["bucketed_stay_rollup", "bucketed_first_admissions", "bucketed_lookback"])
def test_no_exchange_in_the_plan(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "Exchange" not in plan and "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan


class Hot:
    """Sources in which one patient, and the missing patient, hold most records."""

    def __init__(self, src):
        who = lambda df, n: df.withColumn("link_no", F.when(F.xxhash64(*df.columns) % 3 == 0, F.lit("77")).when(
            F.abs(F.xxhash64(*df.columns)) % 4 == 1, F.lit(None)).otherwise(F.col("link_no")))
        self.episodes, self.episodes_historic = who(src.episodes, 1), who(src.episodes_historic, 2)
        self.deaths, self.postcode_lookup = who(src.deaths, 3), src.postcode_lookup


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_hot_patients_go_aside_and_nothing_changes(spark, monkeypatch, fresh):
    monkeypatch.setattr("epistand.sources.patient_table.LEAST_ASIDE", 100)
    src = Hot(Sources(spark, SF))
    t = patient_table(spark, patient_plans.base_records(src), "hot", name=fresh)
    assert isinstance(t, PatientTable) and t.heavy is not None
    assert {r.link_no for r in t.heavy.select("link_no").distinct().collect()} == {"77", None}
    assert not t.light.where("link_no = '77' or link_no is null").count()
    stays = stacked_stays(src, COPD_STAY_CODES, T_COPD.stay_window)
    assert rows(patient_plans.stays(t, COPD_STAY_CODES, T_COPD.stay_window).drop("zone")) == rows(stays)
    events = death_events(copd.deaths(src, T_COPD)).unionByName(resident_by_lookup(stays, src.postcode_lookup), allowMissingColumns=True)
    want = incident_events_simple(events, min_gap_years=1.0).drop("cal_year", "cod", "country_of_residence")
    got = patient_plans.incident(t, COPD_STAY_CODES, T_COPD.stay_window, COPD_DEATH_CODES, T_COPD.death_window, T_COPD.lookback)
    ties = ["linkno", "doadm", "source_rank"]  # equal deaths of a day have no order of their own
    assert rows(got.select(*ties)) == rows(want.select(*ties)) and set(LOOKBACK_COLUMNS) <= set(got.columns)
    e = src.episodes.where(F.col("main_condition").rlike(ASTHMA_STAY_CODES.regex) & F.col("sex").isin("1", "2")
                           & F.col("admission_date").between(*map(F.lit, T_ASTHMA.stay_window)))
    first = resident_by_lookup(first_per_patient_year(e), src.postcode_lookup)
    assert rows(patient_plans.first_admissions(t, ASTHMA_STAY_CODES, T_ASTHMA.stay_window)) == rows(first)


class Strays(Hot):
    """Sources with a few records of a missing patient, and patients with several postcodes."""

    def __init__(self, src):
        for name in ("episodes", "episodes_historic", "deaths"):
            df = getattr(src, name)
            h = F.abs(F.xxhash64(*df.columns))
            df = df.withColumn("link_no", F.when(h % 100 == 0, F.lit(None)).otherwise(F.col("link_no")))
            if name != "deaths":
                df = df.withColumn("dr_postcode", F.when(h % 3 == 1, (h % 150).cast("string")).otherwise(F.col("dr_postcode")))
            setattr(self, name, df)
        self.postcode_lookup = src.postcode_lookup


@pytest.mark.parametrize("sources", [Sources, Hot, Strays])
def test_areas_looked_up_by_patient_are_those_of_each_record(spark, monkeypatch, fresh, sources):
    monkeypatch.setattr("epistand.sources.patient_table.LEAST_ASIDE", 100)
    monkeypatch.setattr("epistand.sources.patient_table.TASK_ROWS", 200)
    src = Sources(spark, SF) if sources is Sources else sources(Sources(spark, SF))
    t = patient_table(spark, patient_plans.source_records(src), "areas", name=fresh, lookup=src.postcode_lookup)
    want = patient_plans.base_records(src).drop("record_no")
    assert rows(t.per_patient(lambda x: x.select(*want.columns))) == rows(want)
    assert not t.light.where("link_no is null").count()
    # a bucket is written by several tasks, each with records of one bucket only
    parts = t.light.groupBy(F.col("_metadata.file_name").alias("f"), F.expr("pmod(hash(link_no), 8)").alias("b")).count().collect()
    assert t.buckets == 8 and len({r.f for r in parts}) == len(parts) > 16
    assert {int(r.f.split("_")[1].split(".")[0]) for r in parts} == {r.b for r in parts} == set(range(8))


def test_whole_records_are_exchanged_once(spark, fresh):
    src = Sources(spark, SF)
    places = src.episodes.select("link_no", "dr_postcode").distinct()
    plan = plan_of(_with_area_inside(src.episodes, places, src.postcode_lookup, 16))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(link_no" in line and "REPARTITION_BY_NUM" in line]
    above = plan[:plan.index("Exchange")]
    assert len(wide) == 2 and "ShuffledHashJoin [link_no" in above and "Sort " not in above


def test_repeated_postcode_stops_the_layout(spark, fresh):
    src = Hot(Sources(spark, SF))
    twice = src.postcode_lookup.unionAll(src.postcode_lookup)
    with pytest.raises(Exception, match="more than once"):
        patient_table(spark, patient_plans.source_records(src), "twice", name=fresh, lookup=twice)


def test_table_is_reused_and_superseded_ones_are_dropped(spark, fresh):
    records = patient_plans.base_records(Sources(spark, SF))
    a = patient_table(spark, records, "state1", name=fresh)
    inside = lambda t: {f: os.path.getmtime(os.path.join(t.folder, f)) for f in os.listdir(t.folder)}
    before = inside(a)
    assert inside(patient_table(spark, records, "state1", name=fresh)) == before
    b = patient_table(spark, records, "state2", buckets=16, name=fresh)
    assert b.buckets == 16 and os.path.isdir(b.folder) and not os.path.exists(a.folder)


def test_fingerprint_follows_the_files(spark):
    d = tempfile.mkdtemp(prefix="epistand-test-", dir="/tmp")
    path = os.path.join(d, "x.parquet")
    spark.range(5).write.parquet(path)
    first = fingerprint(spark, [path], "p")
    assert first == fingerprint(spark, [path], "p") != fingerprint(spark, [path], "q")
    spark.range(6).write.mode("overwrite").parquet(path)
    assert fingerprint(spark, [path], "p") != first


def test_unfinished_table_is_written_anew(spark, fresh):
    src = Sources(spark, SF)
    twice = Hot(src)
    twice.postcode_lookup = src.postcode_lookup.unionAll(src.postcode_lookup)
    with pytest.raises(Exception, match="more than once"):
        patient_table(spark, patient_plans.base_records(twice), "twice", name=fresh)
    again = patient_table(spark, patient_plans.base_records(src), "twice", name=fresh)
    assert again.light.where("source_rank = 0").count() == src.deaths.count() and again.heavy is None


def test_no_records(spark, fresh):
    records = patient_plans.base_records(Sources(spark, SF)).limit(0)
    t = patient_table(spark, records, "none", name=fresh)
    assert t.heavy is None and patient_plans.stays(t, COPD_STAY_CODES, T_COPD.stay_window).count() == 0


def test_population_folders_of_the_event_years_only(spark):
    q = queries()["cells_of_event_years"](spark, SF)
    q.collect()
    plan = plan_of(q)
    assert "dynamicpruningexpression(year" in plan and "SubqueryBroadcast" in plan or "dynamicpruning#" in plan
    scan = next(line for line in plan.splitlines() if "base-population" in line)
    assert "PartitionFilters: [" in scan and "dynamicpruning" in scan
