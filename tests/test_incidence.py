import datetime as dt

import pytest
from pyspark.sql import functions as F

from epistand.operators.incidence import incident_events, incident_events_simple

SCHEMA = "linkno string, cis string, source_rank int, doadm date, dodis date"
D = dt.date
CASES = [
    ("A", "a1", 1, D(2005, 1, 1), D(2005, 1, 10)),
    ("A", "a2", 1, D(2010, 1, 1), D(2010, 1, 5)),
    ("A", "a3", 1, D(2020, 6, 1), D(2020, 6, 3)),
    ("B", "b1", 1, D(2010, 1, 1), D(2010, 1, 10)),
    ("B", "b2", 1, D(2020, 1, 5), D(2020, 1, 6)),
    ("C", "c1", 1, D(2010, 1, 1), D(2010, 1, 10)),
    ("C", "c2", 1, D(2020, 1, 8), D(2020, 1, 9)),
    ("D", None, 0, D(2012, 5, 1), D(2012, 5, 1)),
    ("D", "d1", 1, D(2012, 5, 1), D(2012, 5, 2)),
]


def _kept(df):
    return sorted((r.linkno, r.cis) for r in df.collect())


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_lookback_from_discharge(spark, ranges):
    ev = spark.createDataFrame(CASES, SCHEMA)
    got = _kept(incident_events(ev, gap_from="dodis", min_gap_years=10, ranges=ranges))
    assert got == sorted([("A", "a1"), ("A", "a3"), ("B", "b1"), ("C", "c1"), ("C", "c2"), ("D", None)],
                         key=lambda t: (t[0], t[1] or ""))


def test_lookback_from_admission(spark):
    ev = spark.createDataFrame(CASES, SCHEMA)
    got = _kept(incident_events(ev, gap_from="doadm", min_gap_years=10))
    assert ("B", "b2") in got and ("A", "a2") not in got


def test_null_previous_discharge_counts_as_no_record(spark):
    ev = spark.createDataFrame([("E", "e1", 1, D(2000, 1, 1), None), ("E", "e2", 1, D(2000, 6, 1), D(2000, 6, 2))], SCHEMA)
    assert len(_kept(incident_events(ev, min_gap_years=10))) == 2


def test_hot_patient_split_over_slices_matches_whole_history(spark):
    # One patient holds most rows; gaps vary so that slices start with kept and dropped rows.
    rows = [("HOT", f"h{i:05d}", 1 + (i % 2), D(1990, 1, 1) + dt.timedelta(days=(i * 37) % 9000 + i // 7),
             D(1990, 1, 1) + dt.timedelta(days=(i * 37) % 9000 + i // 7 + i % 5)) for i in range(3000)]
    rows += [(f"p{i}", f"x{i}", 1, D(2000, 1, 1) + dt.timedelta(days=i * 400), D(2000, 1, 3) + dt.timedelta(days=i * 400))
             for i in range(50)]
    rows += [(None, "n1", 1, D(2001, 1, 1), D(2001, 1, 2)), (None, "n2", 1, D(2001, 3, 1), D(2001, 3, 2)),
             ("Q", "q1", 1, None, D(2001, 1, 2))]
    ev = spark.createDataFrame(rows, SCHEMA)
    for gap_from, years in (("dodis", 1.0), ("doadm", 0.05), ("dodis", 10.0)):
        want = _kept_all(incident_events_simple(ev, gap_from=gap_from, min_gap_years=years))
        for ranges in (3, 32):
            got = _kept_all(incident_events(ev, gap_from=gap_from, min_gap_years=years, ranges=ranges))
            assert got == want, (gap_from, years, ranges)


def _kept_all(df):
    return sorted((r.linkno or "", r.cis or "") for r in df.collect())


def test_output_subset_and_monotone_in_gap(spark):
    ev = spark.createDataFrame(CASES, SCHEMA)
    small = set(_kept(incident_events(ev, min_gap_years=1)))
    large = set(_kept(incident_events(ev, min_gap_years=12)))
    assert large <= small <= set((r[0], r[1]) for r in CASES)
    assert incident_events(ev).columns == ev.columns


def test_plan_has_no_global_window(spark):
    ev = spark.createDataFrame(CASES, SCHEMA)
    plan = incident_events(ev)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_hot_patient_rows_spread_over_tasks(spark):
    # A third of all rows belong to one patient; after the look-back exchange they must not sit in
    # one partition (a plain partitionBy(patient) window would put them all in one task).
    hot = [("HOT", f"h{i}", 1, D(2000, 1, 1) + dt.timedelta(days=i % 3000), D(2000, 1, 2) + dt.timedelta(days=i % 3000))
           for i in range(3000)]
    rest = [(f"p{i}", f"x{i}", 1, D(2000, 1, 1) + dt.timedelta(days=i % 3000), D(2000, 1, 2) + dt.timedelta(days=i % 3000))
            for i in range(6000)]
    ev = spark.createDataFrame(hot + rest, SCHEMA)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # at this size AQE would merge every partition into one
    try:
        out = incident_events(ev, min_gap_years=0.0)
        parts = out.where(F.col("linkno") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set(key, "true")
    assert parts >= 4


@pytest.mark.parametrize("ids", ["prefix", "null"])
def test_hot_patient_day_spreads(spark, ids):
    # One patient-day holds a third of the rows, its stay ids sharing a prefix or all NULL.
    day = D(2005, 3, 1)
    hot = [("HOT", f"CIS{i:04d}" if ids == "prefix" else None, 0, day, day + dt.timedelta(days=i)) for i in range(1500)]
    rest = [(f"p{i}", f"x{i}", 1, D(2000, 1, 1) + dt.timedelta(days=i), D(2000, 1, 2) + dt.timedelta(days=i)) for i in range(3000)]
    ev = spark.createDataFrame(hot + rest, SCHEMA)
    want = _kept_all(incident_events_simple(ev, gap_from="dodis", min_gap_years=0.5))
    assert _kept_all(incident_events(ev, gap_from="dodis", min_gap_years=0.5)) == want
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        out = incident_events(ev, gap_from="dodis", min_gap_years=-1000.0)
        parts = out.where(F.col("linkno") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set(key, "true")
    assert parts >= 4


def test_any_date_id_type_and_nulls_match_whole_history(spark):
    # dates before 1970, integer stay ids, NULL ids, dates, patients, and same-day deaths
    rows = [("A", 9, 1, D(2000, 1, 1), D(2000, 1, 1), "x"), ("A", 10, 1, D(2000, 1, 1), D(2000, 1, 2), "x"),
            ("A", 100, 1, D(2012, 1, 1), D(2012, 1, 1), "x"), ("B", 1, 1, D(1965, 1, 1), D(1965, 1, 2), "x"),
            ("B", 2, 1, D(1966, 1, 1), D(1966, 1, 2), "x"), ("B", 3, 1, D(1971, 1, 1), D(1971, 1, 2), "x"),
            ("C", None, 0, D(2001, 1, 1), D(2001, 1, 1), "p"), ("C", None, 0, D(2001, 1, 1), D(2001, 1, 1), "q"),
            (None, 5, 1, None, D(2001, 1, 1), "x"), (None, 6, 1, D(1960, 5, 5), None, "x"), (None, None, None, None, None, None)]
    rows += [(f"z{i % 7}", i % 11, 1 + i % 2, D(1955, 1, 1) + dt.timedelta(days=i * 997 % 15000), D(1960, 1, 1), str(i % 3)) for i in range(200)]
    ev = spark.createDataFrame(rows, "linkno string, cis int, source_rank int, doadm date, dodis date, cause string")
    for gap_from, years in (("dodis", 10.0), ("doadm", 1.0)):
        want = sorted(map(repr, incident_events_simple(ev, gap_from=gap_from, min_gap_years=years).collect()))
        for ranges in (1, 7, 64):
            got = sorted(map(repr, incident_events(ev, gap_from=gap_from, min_gap_years=years, ranges=ranges).collect()))
            assert got == want
    kept = {(r.linkno, r.cis) for r in incident_events(ev).collect()}
    assert ("A", 9) in kept and ("A", 10) not in kept and ("B", 2) not in kept and ("B", 3) not in kept


def test_checkpoint_folder_is_required_off_local(monkeypatch):
    from epistand import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
