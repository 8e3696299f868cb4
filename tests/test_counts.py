from epistand.operators.counts import counts_with_total


def test_grouping_sets_total_not_confused_with_null_sex(spark):
    df = spark.createDataFrame([(2001, "1"), (2001, "2"), (2001, "2"), (2001, None), (2002, "9")], "cal_year int, sex string")
    rows = {(r.cal_year, r.sex): r.n for r in counts_with_total(df).collect()}
    assert rows[(2001, "All")] == 4
    assert rows[(2001, "Male")] == 1 and rows[(2001, "Female")] == 2
    assert rows[(2001, None)] == 1
    assert rows[(2002, "9")] == 1 and rows[(2002, "All")] == 1
