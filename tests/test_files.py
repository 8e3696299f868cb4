"""Range reading and filling, typed CSV with rejects, atomic publication, audit of denominators."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from epistand.operators.reshape import fill_down
from epistand.plans import audit, publication
from epistand.plans.publication import current, manifest, publish_version, read_published
from epistand.plans.publish import LAYOUTS
from epistand.sources.line_ranges import fill_down_ranges, numbered_lines
from epistand.sources.readers import text_lines
from epistand.sources.schemas import CHART_CSV
from epistand.sources.sinks import write_chart_csv
from epistand.sources.typed_csv import accepted, read_checked, reject_counts, rejects


def _tmp():
    return tempfile.mkdtemp(prefix="epistand-test-", dir="/tmp")


def test_line_numbers_over_ranges(spark):
    d, rng = _tmp(), random.Random(2)
    for name in ("a.csv", "b.csv", "empty.csv"):
        with open(os.path.join(d, name), "w") as f:
            f.write("" if name == "empty.csv" else "\n".join("é" * rng.choice([0, 1, 5, 400]) + f" line {i}" for i in range(300)))
    lines = numbered_lines(spark, d, range_bytes=3000)
    got = sorted((os.path.basename(r.release), r.line_no, r.value) for r in lines.collect())
    want = sorted((os.path.basename(r.release), r.line_no, r.value) for r in text_lines(spark, d).collect() if "empty" not in r.release)
    assert got == want and len(got) == 600
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "wholetext" not in plan


@pytest.mark.parametrize("segment", [1, 7, 64, 100000])
def test_fill_down_over_segments_equals_the_window(spark, segment):
    rng = random.Random(segment)
    cell = lambda: rng.choice([None, None, None, "x", "y", ""])
    rows = [(r, i * rng.choice([1, 1, 3]) + 1000 * i, cell(), rng.choice([None, i]), cell()) for r in ("p", "q", None) for i in range(200)]
    df = spark.createDataFrame(rows, "release string, line_no int, a string, b int, untouched string")
    got = fill_down_ranges(df, ["a", "b"], "release", "line_no", segment * 1000)
    want = fill_down(df, ["a", "b"], "release", "line_no")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert fill_down_ranges(df.limit(0), ["a"], "release", "line_no").count() == 0


def test_typed_csv_keeps_bad_values_as_rejects(spark):
    d = _tmp()
    with open(os.path.join(d, "c.csv"), "w") as f:
        f.write("class1,class2,measure\nMale,2019/20,12.345\nNA,2020/21, \nFemale,,2.25\nA,B,12x\nA,B,12x\nC,D,1e3\nonly,two\n\"q,1\",B,NaN?\n")
    checked = read_checked(spark, d, CHART_CSV)
    got = sorted((tuple(r) for r in accepted(checked).collect()), key=repr)
    assert got == sorted([("Male", "2019/20", 12.345), (None, "2020/21", None), ("Female", None, 2.25), ("C", "D", 1000.0)], key=repr)
    bad = {(r.column, r.value): r.n for r in rejects(checked).collect()}
    assert bad == {("measure", "12x"): 2, ("measure", "NaN?"): 1, ("_row", "only,two"): 1}
    counts = reject_counts(checked, CHART_CSV).first()
    assert (counts.rows, counts.rejected, counts.bad_measure, counts.bad_class1, counts.bad_lines) == (8, 4, 3, 0, 1)
    assert accepted(checked, required=["class1"]).count() == 7  # a bad measure alone is let through as NULL


def _chart(spark, shift=0.0):
    return spark.createDataFrame([("2001/02", "Male", 1.5 + shift), ("2000/01", "Female", None), ("2000/01", "Male", 0.25)],
                                 "year string, sex string, rate double")


def test_publication_is_atomic(spark, monkeypatch):
    d = _tmp()
    assert current(spark, d) is None and manifest(spark, d) == {}
    with pytest.raises(ValueError):
        read_published(spark, d, "chart")
    first = publish_version({"chart": _chart(spark)}, d)
    assert first == manifest(spark, d) and first["chart"]["rows"] == 3 and first["chart"]["columns"] == ["year", "sex", "rate"]
    version = current(spark, d)
    broken = _chart(spark).withColumn("rate", F.when(F.col("sex") == "Male", F.raise_error(F.lit("broken"))).otherwise(F.col("rate")))
    with pytest.raises(Exception, match="broken"):
        publish_version({"a": _chart(spark, 5.0), "chart": broken}, d)
    assert current(spark, d) == version and read_published(spark, d, "chart").count() == 3
    monkeypatch.setattr(publication, "write_chart_csv", lambda df, path, **k: df.limit(2).write.option("header", True).csv(path))
    with pytest.raises(ValueError, match="differ"):  # rows lost on the way are noticed before the pointer moves
        publish_version({"chart": _chart(spark)}, d)
    monkeypatch.undo()
    assert current(spark, d) == version
    again = publish_version({"chart": _chart(spark)}, d)
    assert again == first and current(spark, d) != version  # equal outputs, equal manifest
    publish_version({"chart": _chart(spark, 1.0), "none": _chart(spark).limit(0), "none2": _chart(spark).where("year = '1'")}, d)
    assert manifest(spark, d)["none"]["rows"] == manifest(spark, d)["none2"]["rows"] == 0
    assert len([f for f in os.listdir(d) if f.startswith("version-")]) == 2
    assert sorted(r.rate or "" for r in read_published(spark, d, "chart").collect()) == ["", "0.25", "2.5"]


def _lines_of(path):
    (name,) = [f for f in os.listdir(path) if f.endswith(".csv")]
    with open(os.path.join(path, name)) as f:
        return f.read().splitlines()


ROWS = {
    "top10causes_chart1": ("release string, class1 string, measure double, position int", [("1995", "B", 2.5, 2), ("1995", "A", 2.5, 1), ("1995", "C", 0.5, 3)],
                           ["class1,measure", "C,0.5", "A,2.5", "B,2.5"]),
    "top10causes_chart2": ("release string, class1 string, measure double, position int", [("1995", "B", 9.5, 2), ("1995", "A", 2.5, 1)],
                           ["class1,measure", "A,2.5", "B,9.5"]),
    "incidence_agesex_chart_1": ("year string, sex_agegrp string, sex string, agegrp string, rate double",
                                 [("2001/02", "F x", "Female", "x", 1.0), ("2000/01", "M x", "Male", "x", 2.0), ("2000/01", "F x", "Female", "x", 3.0),
                                  ("2000/01", "F a", "Female", "a", 4.0)],
                                 ["year,sex_agegrp,sex,agegrp,rate", "2000/01,F a,Female,a,4.0", "2000/01,F x,Female,x,3.0", "2001/02,F x,Female,x,1.0",
                                  "2000/01,M x,Male,x,2.0"]),
    "seccare_chart1_pra": ("class2 string, measure double, class1 string", [("2001/02", 1.0, "Male"), ("2000/01", 2.0, "Male"), ("2001/02", None, "Female")],
                           ["class2,measure,class1", "2001/02,NA,Female", "2000/01,2.0,Male", "2001/02,1.0,Male"]),
    "seccare_chart2_pra": ("class2 string, measure double, class1 string", [("2001/02", 1.0, "Male y"), ("2001/02", 2.0, "Male x")],
                           ["class2,measure,class1", "2001/02,2.0,Male x", "2001/02,1.0,Male y"]),
    "undeclared": ("year string, n long", [("2001", 2), ("2000", 7), ("2000", 3)], ["year,n", "2000,3", "2000,7", "2001,2"]),
}


def test_every_layout_pins_header_and_row_order(spark):
    assert set(LAYOUTS) == set(ROWS) - {"undeclared"}
    d = _tmp()
    outputs = {name: spark.createDataFrame(rows, schema) for name, (schema, rows, _) in ROWS.items()}
    entries = publish_version(outputs, d)
    for name, (_, rows, want) in ROWS.items():
        path = f"{current(spark, d)}/{name}"
        path = os.path.join(path, "release=1995") if name.startswith("top10") else path
        assert _lines_of(path) == want, name
        assert entries[name]["rows"] == len(rows)
    with open(f"{current(spark, d)}/manifest.json") as f:
        assert json.load(f) == entries


def test_row_names(spark):
    d = os.path.join(_tmp(), "chart")
    write_chart_csv(_chart(spark).repartition(3), d, order_by=["year", "sex"], columns=["sex", "rate"], row_names=True)
    lines = _lines_of(d)
    assert lines[0].replace('"', "") == ",sex,rate" and lines[1:] == ["1,Female,NA", "2,Male,0.25", "3,Male,1.5"]


def test_audit_comes_from_the_pass_that_makes_the_rates(spark):
    cells = spark.createDataFrame([(2000, "1", 3, None, 1.0), (2000, "1", 4, 0, 1.0), (2000, "2", 5, 10, 1.0), (2001, "1", None, 7, 1.0)],
                                  "year int, sex string, numerator long, denominator long, epop double")
    read = spark.sparkContext.accumulator(0)
    counted = cells.rdd.map(lambda r: (read.add(1), r)[1]).toDF(cells.schema)
    from epistand.operators.standardise import standardised_rates
    rates, row = audit.audited(counted, lambda c: standardised_rates(c, 100000), "made")
    assert row == ("made", 4, 2, 7, 3) and rates.count() == 3 and read.value == 4
    none, row = audit.audited(cells.limit(0), lambda c: standardised_rates(c, 100000), "none")
    assert row[1:] == (0, 0, 0, 0) and none.count() == 0
