"""The code dictionary equals the patterns run on every record, also across code boundaries."""

import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from epistand.operators import codebook
from epistand.operators.codebook import Topics, build_codebook, literals, same_as_patterns, with_topics
from epistand.params import CodeSet
from epistand.plans import topic_masks
from epistand.plans.catalogue import queries
from epistand.sources.testdata import Sources

SF = "/root/testdata/sf0.001"
COLUMNS = ["a", "b", "c", "d"]
TOPICS = Topics(single={"x": CodeSet(prefix3=("E10", "J45")), "y": CodeSet(regex="^E1|0E"), "z": CodeSet(prefix4=("E101",))},
                joined={"any": CodeSet(regex="E1[0-2]"), "long": CodeSet(regex="E101|1E1E1|01")})


def test_literals():
    assert literals("E1[0-2]|J4[56]X") == ["E10", "E11", "E12", "J45X", "J46X"]
    for bad in ("^E1", "E1.", "E1[^0]", "E(1|2)", ""):
        with pytest.raises(ValueError):
            literals(bad)


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(5)
    code = lambda: None if rng.random() < 0.3 else "".join(rng.choice("E1012J") for _ in range(rng.choice([0, 1, 1, 2, 3, 4])))
    return spark.createDataFrame([(i, *(code() for _ in COLUMNS)) for i in range(3000)], "id long, a string, b string, c string, d string")


@pytest.mark.parametrize("bound", [1 << 30, 0])
def test_masks_equal_patterns(spark, records, bound):
    got = with_topics(records, build_codebook(records, COLUMNS, TOPICS), TOPICS, "b", COLUMNS, bound=bound)
    assert got.where(same_as_patterns(got, TOPICS, "b", COLUMNS)).count() == 3000
    for r in got.collect():
        text = "".join(x or "" for x in r[1:5])
        assert r.joined_mask == bool(re.search("E1[0-2]", text)) + 2 * bool(re.search("E101|1E1E1|01", text)), r
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and ("BroadcastHashJoin" in plan) == (bound > 0)


def test_book_is_extended_with_new_codes_only(spark, records):
    first = build_codebook(records.where("id < 1500"), COLUMNS, TOPICS)
    poisoned = first.withColumn("mask", F.lit(64).cast("bigint"))  # kept as it is: known codes aren't matched again
    rows = {r.code: (r.n, r.mask, r.steps) for r in build_codebook(records, COLUMNS, TOPICS).collect()}
    more = {r.code: r for r in build_codebook(records.where("id >= 1500"), COLUMNS, TOPICS, poisoned).collect()}
    old = {r.code for r in first.collect()}
    assert set(more) == set(rows) and all(r.n == rows[c][0] for c, r in more.items())
    assert all(r.mask == (64 if c in old else rows[c][1]) and r.steps == rows[c][2] for c, r in more.items())


def test_unknown_code_stops_the_job(spark, records):
    book = build_codebook(records, COLUMNS, TOPICS).where("code <> 'E1'")
    with pytest.raises(PySparkException, match="not in the book"):
        with_topics(records, book, TOPICS, "a", COLUMNS).select("topic_mask", "joined_mask").collect()


def test_empty_records(spark, records):
    none = records.limit(0)
    assert with_topics(none, build_codebook(none, COLUMNS, TOPICS), TOPICS, "a", COLUMNS).count() == 0


def test_topics_of_the_plans(spark):
    e = Sources(spark, SF).episodes
    got = topic_masks.masked(e, topic_masks.book(e))
    assert got.where(~same_as_patterns(got, topic_masks.TOPICS, "main_condition", topic_masks.CODE_COLUMNS)).count() == 0
    assert len(topic_masks.TOPICS.states) < 16 and codebook.flag("topic_mask", ["p", "q"], "q") is not None


def test_one_scan_gives_all_flags(spark):
    plan = queries()["codebook_stay_flags"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and "RLike" not in plan and "hashpartitioning(link_no" in plan
