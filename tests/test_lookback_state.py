"""Batches of records, late and tied ones included, give the whole-history look-back at every step."""

import os
import random
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from epistand.operators.incidence import incident_events_simple
from epistand.operators.lookback_state import LookbackState
from epistand.params import LookbackParams
from epistand.session import ensure_checkpoint_dir

SCHEMA = "linkno string, cis string, source_rank int, doadm date, dodis date, age int, batch int"
LOOKBACK = LookbackParams(gap_from="dodis", min_gap_years=1.0)
COLUMNS = ["linkno", "cis", "source_rank", "doadm", "dodis", "age"]


def made(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        who = "hot" if rng.random() < 0.3 else rng.choice([None, *"abcdefghij"])
        day = date(1960, 1, 1) + timedelta(days=rng.choice([rng.randint(0, 4000), 100, 101])) if rng.random() < 0.95 else None
        left = None if day is None or rng.random() < 0.05 else day + timedelta(days=rng.randint(0, 600))
        rows.append((who, rng.choice([None, f"s{i}"]), rng.randint(0, 2), day, left, i, rng.randint(1, 4)))
    return rows + [(*rows[3][:6], 2), (*rows[3][:6], 4)]  # equal records in different batches


def folder(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-state-{uuid.uuid4().hex}".replace("file:", "")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("gap_from", ["dodis", "doadm"])
def test_every_step_equals_the_whole_history(spark, gap_from):
    df = spark.createDataFrame(made(3, 400), SCHEMA)
    events = df.drop("batch")
    lookback = LookbackParams(gap_from=gap_from, min_gap_years=1.0)
    # one order of records for both: the tie breaker is a hash of the record's columns in name order
    ordered = events.withColumn("h", F.xxhash64(*sorted(events.columns)))
    state = LookbackState(spark, folder(spark), lookback, keep=["dodis", "age"])
    seen, withdrawn, added = set(), 0, 0
    for batch in (1, 2, 3, 4):
        step = state.advance(df.where(F.col("batch") == batch).drop("batch"), f"batch {batch}")
        assert step.counts["incident"] == step.incident.count()
        assert step.counts["withdrawn"] + step.counts["added"] == step.changes.count()
        withdrawn, added = withdrawn + step.counts["withdrawn"], added + step.counts["added"]
        seen.add(state.generation())
    assert withdrawn > 5 and added >= 0 and seen == {1, 2, 3, 4}
    assert state.rows().count() == df.count()
    want = incident_events_simple(ordered, gap_from=gap_from, min_gap_years=1.0, tie_breakers=("source_rank", "cis", "h"))
    assert rows_of(state.incident()) == rows_of(want)


def test_steps_equal_history_without_ties(spark):
    rows = [r for r in made(8, 300) if r[3] is not None]
    rows = [(r[0], f"s{i}", r[2], r[3] + timedelta(days=7 * i), r[4], i, r[6]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, SCHEMA)
    state = LookbackState(spark, folder(spark), LOOKBACK, keep=["age"])
    for batch in (1, 2, 3, 4):
        state.advance(df.where(F.col("batch") == batch).drop("batch"), str(batch))
        assert rows_of(state.incident()) == rows_of(incident_events_simple(df.where(F.col("batch") <= batch), min_gap_years=1.0))


def test_only_state_and_batch_are_read_and_a_failed_or_repeated_step_is_safe(spark):
    df = spark.createDataFrame(made(5, 200), SCHEMA)
    state = LookbackState(spark, folder(spark), LOOKBACK, keep=["age"])
    state.advance(df.where("batch = 1").drop("batch"), "1")
    second = df.where("batch = 2").drop("batch")
    state.advance(second, "2")
    answer = rows_of(state.incident())
    with pytest.raises(Exception, match="broken"):
        state.advance(second.withColumn("age", F.raise_error(F.lit("broken")).cast("int")), "3")
    assert state.generation() == 2 and rows_of(state.incident()) == answer
    state.advance(second, "2")  # the same label again replaces the step
    assert state.generation() == 3 and rows_of(state.incident()) == answer
    state.advance(df.where("batch = 3").drop("batch"), "3")
    kept = sorted(f for f in os.listdir(state.folder) if f.startswith("gen-"))
    assert kept == ["gen-000003", "gen-000004"]
    again = LookbackState(spark, state.folder, LOOKBACK, keep=["age"])  # another run goes on from the folder
    again.advance(df.where("batch = 4").drop("batch"), "4")
    assert again.rows().count() == df.count()


def test_empty_batches(spark):
    df = spark.createDataFrame(made(6, 50), SCHEMA)
    state = LookbackState(spark, folder(spark), LOOKBACK, keep=["age"])
    with pytest.raises(ValueError):
        state.incident()
    assert state.advance(df.limit(0).drop("batch"), "none").counts["records"] == 0
    state.advance(df.drop("batch"), "all")
    answer = rows_of(state.incident())
    assert state.advance(df.limit(0).drop("batch"), "nothing new").counts == {"records": 0, "incident": 0, "withdrawn": 0, "added": 0}
    assert rows_of(state.incident()) == answer
