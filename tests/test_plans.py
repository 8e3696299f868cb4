"""Every topic plan runs end to end on the smallest tables and returns chart-shaped outputs."""

import os
import tempfile

import pytest

from epistand.plans import allergy, asthma, causes, copd, diabetes, epilepsy, ms
from epistand.plans import catalogue as c
from epistand.plans.publish import publish
from epistand.sources import testdata
from epistand.sources.testdata import Sources

SF = "/root/testdata/sf0.001"

EXPECTED = {
    "asthma": {"deaths_chart": ["cal_year", "sex", "n"], "sex_chart": ["year", "sex", "rate"],
               "all_chart": ["year", "rate", "sex"], "underten_chart": ["year", "sex", "rate"],
               "tenplus_chart": ["year", "sex", "rate"]},
    "diabetes": {"secondarycare_chart1": ["class2", "class1", "numerator", "rate"],
                 "secondarycare_chart2": ["class2", "class1", "numerator", "rate"],
                 "mortality_chart1": ["class2", "class1", "numerator", "rate"]},
    "allergy": {"scotland_chart": ["year", "type", "numerator", "rate"]},
    "copd": {"deaths_scotland": ["year", "sex", "rate"], "all_copd_scotland_chart": ["year", "sex", "rate"],
             "copd_undersixtyfive_chart": ["year", "sex", "rate"],
             "copd_sixtyfive_eightyfour_chart": ["year", "sex", "rate"],
             "copd_eightyfiveplus_chart": ["year", "sex", "rate"],
             "copd_deprivation_chart1": ["class1", "measure", "class2"],
             "copd_deprivation_chart2": ["class1", "measure", "class2"]},
    "epilepsy": {"incidence_deaths_chart_1": ["class2", "measure", "class1"],
                 "incidence_agesex_chart_1": ["year", "sex_agegrp", "sex", "agegrp", "rate"]},
    "ms": {"mortality_chart1": ["class1", "measure", "class2"], "seccare_chart1_pra": ["class2", "measure", "class1"],
           "seccare_chart2_pra": ["class2", "measure", "class1"]},
}


@pytest.mark.parametrize("topic,module,params", [
    ("asthma", asthma, c.T_ASTHMA), ("diabetes", diabetes, c.T_DIABETES), ("allergy", allergy, c.T_ALLERGY),
    ("copd", copd, c.T_COPD), ("epilepsy", epilepsy, c.T_EPILEPSY), ("ms", ms, c.T_MS)])
def test_topic_runs(spark, topic, module, params):
    out = module.run(Sources(spark, SF), params)
    assert {k: v.columns for k, v in out.items()} == EXPECTED[topic]
    for df in out.values():
        df.count()


def test_causes_run_and_publish(spark):
    out = causes.run(testdata.vital_events_lines(spark, SF), c.T_CAUSES)
    for df in out.values():
        rows = df.collect()
        assert rows and all(r.position >= 1 for r in rows)
        per_release = {}
        for r in rows:
            per_release[r.release] = per_release.get(r.release, 0) + 1
        assert max(per_release.values()) <= 10
    folder = tempfile.mkdtemp(prefix="epistand-publish-", dir="/tmp")
    paths = publish(out, folder)
    assert all(os.path.isdir(p) for p in paths)


def test_written_chart_has_declared_columns_and_order(spark):
    rows = [("1995", "Asthma", 7.5, 2), ("1995", "Burns", 2.5, 3), ("1995", "Cancer", 16.4, 1), ("1996", "Asthma", 1.0, 1)]
    df = spark.createDataFrame(rows, "release string, class1 string, measure double, position int")
    folder = tempfile.mkdtemp(prefix="epistand-publish-", dir="/tmp")
    (path,) = publish({"top10causes_chart1": df}, folder)
    written = os.path.join(path, "release=1995")
    (name,) = [f for f in os.listdir(written) if f.endswith(".csv")]
    with open(os.path.join(written, name)) as f:
        assert f.read().splitlines() == ["class1,measure", "Burns,2.5", "Asthma,7.5", "Cancer,16.4"]
