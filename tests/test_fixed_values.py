"""Fixed values against literals: the oracle reads the same constants, so only these tests see a wrong one."""

from epistand import params as P
from epistand.plans import epilepsy, ms


def test_standard_population():
    assert P.EPOP_WEIGHTS == [5000, 5500, 5500, 5500, 6000, 6000, 6500, 7000, 7000, 7000, 7000, 6500, 6000, 5500, 5000, 4000, 2500, 1500, 1000]
    assert sum(P.EPOP_WEIGHTS) == 100000


def test_band_totals_and_ages():
    totals = lambda bands: [(b.label, b.min_age, b.max_age, b.epop_total) for b in bands]
    assert totals(P.ASTHMA_BANDS) == [(1, None, 9, 10500), (2, 10, None, 89500)]
    assert totals(P.DIABETES_BANDS) == [("<25", None, 24, 27500), ("25-44", 25, 44, 26500), ("45-64", 45, 64, 26500), ("65+", 65, None, 19500)]
    assert totals(P.COPD_BANDS) == [(1, None, 64, 80500), (2, 65, 84, 17000), (3, 85, None, 2500)]
    assert totals(P.COPD_DEPRIVATION_BANDS) == [("65-84", 65, 84, 17000), ("+85", 85, None, 2500)]
    assert totals(P.EPILEPSY_BANDS) == [(1, None, 14, 16000), (2, 15, 54, 52000), (3, 55, None, 32000)]
    assert totals(P.MS_BANDS) == [(1, None, 24, 27500), (2, 25, 59, 47000), (3, 60, None, 25500)]


def test_code_sets():
    assert P.ASTHMA_DEATH_CODES == P.CodeSet(("J45", "J46", "493"), ("-493",))
    assert P.ASTHMA_STAY_CODES.regex == "J4[5-6]" and P.DIABETES_CODES.regex == "E1[01234]"
    assert P.DIABETES_KETO_CODES.regex == "E101|E111|E121|E131|E141" and P.COPD_DEATH_CODES.regex == "^J4[0-4]"
    assert P.COPD_STAY_CODES == P.CodeSet(("J40", "J41", "J42", "J43", "J44", "490", "491", "492", "496"), ("-490", "-491", "-492", "-496"))
    assert P.EPILEPSY_CODES == P.CodeSet(("G40", "G41", "345"), ("-345",))
    assert P.MS_CODES == P.CodeSet(("G35", "340"), ("-340",))
    assert len(P.ALLERGY_FLAGS) == 12 and P.ALLERGY_TOTAL_FLAGS[-1] == "allergy_unspec"


def test_chart_names():
    assert epilepsy.BAND_NAMES == {1: "<15", 2: "15-54", 3: "55+"} and ms.BAND_NAMES == {1: "<25", 2: "25-59", 3: "60+"}
    assert P.SEX_LABELS == {"1": "Male", "2": "Female"}


def test_windows():
    e, m = epilepsy.EpilepsyParams(), ms.MsParams()
    assert e.lookback.gap_from == "doadm" and m.lookback.gap_from == "dodis"
    assert e.lookback.min_gap_years == m.lookback.min_gap_years == 10.0 and e.lookback.days_per_year == 365.0
