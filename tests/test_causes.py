import pytest

from epistand.operators.reshape import fill_down, read_sections
from epistand.operators.topcauses import top_causes


def test_fill_down_per_release(spark):
    rows = [("r1", 1, "A00", "All"), ("r1", 2, None, "M"), ("r1", 3, None, "F"), ("r1", 4, "B01", "All"),
            ("r1", 5, None, "M"), ("r2", 1, None, "M")]
    df = spark.createDataFrame(rows, "release string, line_no int, code string, sex string")
    got = [(r.release, r.code) for r in fill_down(df, ["code"], "release", "line_no").orderBy("release", "line_no").collect()]
    assert got == [("r1", "A00"), ("r1", "A00"), ("r1", "A00"), ("r1", "B01"), ("r1", "B01"), ("r2", None)]


def test_top_causes_hand_case(spark):
    causes = [("A00-Y89", "All causes", 1000), ("V01-X59", "Accidents", 100), ("X40-X49", "Poisonings", 40),
              ("A00-B99", "A. summary", 300), ("C00-C97", "Malignant neoplasms", 200), ("I20-I25", "Heart", 80),
              ("I60-I69", "Stroke", 60)]
    # Two sex rows per cause, split unevenly; the "All" rows must be ignored.
    rows = []
    for code, cause, n in causes:
        rows += [("r", code, cause, "M", "all_ages", float(n - n // 3)), ("r", code, cause, "F", "all_ages", float(n // 3)),
                 ("r", code, cause, "All", "all_ages", float(n))]
    clean = spark.createDataFrame(rows, "release string, ICD_10_code string, cause_of_death string, sex string, "
                                        "age string, num_deaths double")
    got = [(r.class1, r.measure) for r in top_causes(clean, ages=["all_ages"]).orderBy("position").collect()]
    assert got == [("Accidental poisonings including drug abuse", 4.0), ("Stroke", 6.0), ("Accidents", 6.0), ("Heart", 8.0)]


def test_read_sections_skips_empty_rows_in_first_section_only(spark):
    lines = [("r", 1, "title, with comma"), ("r", 2, '"A00","Cause","All","1,234","-"'), ("r", 3, ',,,,'),
             ("r", 4, 'junk'), ("r", 5, ',,"M","12","3"'), ("r", 6, ',,,,')]
    df = spark.createDataFrame(lines, "release string, line_no int, value string")
    names = ["code", "cause", "sex", "all_ages", "a1"]
    out = read_sections(df, [(1, 2, True), (4, 2, False)], names).orderBy("line_no").collect()
    assert [r.line_no for r in out] == [2, 5, 6]
    assert out[0].all_ages == "1,234" and out[0].a1 == "-"
    assert out[2].code is None and out[2].sex is None


@pytest.mark.parametrize("missing", [True, False])
def test_subtraction_with_missing_poisonings(spark, missing):
    rows = [("r", "A", "All causes", "M", "all_ages", 100.0), ("r", "V", "Accidents", "M", "all_ages", 30.0)]
    if not missing:
        rows.append(("r", "X", "Poisonings", "M", "all_ages", 10.0))
    clean = spark.createDataFrame(rows, "release string, ICD_10_code string, cause_of_death string, sex string, "
                                        "age string, num_deaths double")
    got = {r.class1: r.measure for r in top_causes(clean, ages=["all_ages"]).collect()}
    assert got["Accidents"] == (30.0 if missing else 20.0)


def test_unpivot_all_but_keeps_nulls(spark):
    from epistand.operators.reshape import unpivot_all_but
    df = spark.createDataFrame([(2001, "1", 3, None), (2001, "2", 0, 5)], "year int, sex string, a int, b int")
    rows = sorted(tuple(r) for r in unpivot_all_but(df, ["year", "sex"], "type", "numerator", "long").collect())
    assert rows == [(2001, "1", "a", 3), (2001, "1", "b", None), (2001, "2", "a", 0), (2001, "2", "b", 5)]
