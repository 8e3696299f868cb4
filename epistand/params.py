"""Fixed values and pipeline parameters.

The values under "fixed values" must equal the published method for results to match: the
European Standard Population weights per five-year band, the coarse bands each topic reports and
the clinical code sets each topic selects.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------------------------
# European Standard Population weight of five-year age bands 1..19
# (0-4, 5-9, ..., 85-89, 90+). They sum to 100000.
EPOP_WEIGHTS = [5000, 5500, 5500, 5500, 6000, 6000, 6500, 7000, 7000, 7000,
                7000, 6500, 6000, 5500, 5000, 4000, 2500, 1500, 1000]
# The age band of an age is floor(age / 5) + 1, capped at band 19 for 90-200.
AGE_BAND_MAX_AGE = 200
AGE_BAND_COUNT = 19
# ---------------------------------------------------------------------------------------------


def epop_total(bands) -> int:
    """Sum of the EPOP weights of the given five-year bands (1-based)."""
    return sum(EPOP_WEIGHTS[b - 1] for b in bands)


@dataclass(frozen=True)
class CoarseBand:
    """One reported age group: a label, the ages it covers and the five-year bands it spans."""

    label: object
    min_age: int | None
    max_age: int | None
    first_grp: int
    last_grp: int

    @property
    def grps(self):
        return range(self.first_grp, self.last_grp + 1)

    @property
    def epop_total(self) -> int:
        return epop_total(self.grps)


def _bands(*spec):
    return tuple(CoarseBand(*s) for s in spec)


# Coarse bands per topic (label, min age, max age, first five-year band, last band).
ASTHMA_BANDS = _bands((1, None, 9, 1, 2), (2, 10, None, 3, 19))
DIABETES_BANDS = _bands(("<25", None, 24, 1, 5), ("25-44", 25, 44, 6, 9),
                        ("45-64", 45, 64, 10, 13), ("65+", 65, None, 14, 19))
COPD_BANDS = _bands((1, None, 64, 1, 13), (2, 65, 84, 14, 17), (3, 85, None, 18, 19))
COPD_DEPRIVATION_BANDS = _bands(("65-84", 65, 84, 14, 17), ("+85", 85, None, 18, 19))
EPILEPSY_BANDS = _bands((1, None, 14, 1, 3), (2, 15, 54, 4, 11), (3, 55, None, 12, 19))
MS_BANDS = _bands((1, None, 24, 1, 5), (2, 25, 59, 6, 12), (3, 60, None, 13, 19))


@dataclass(frozen=True)
class CodeSet:
    """Clinical codes selected by 3- and 4-character prefix lists and/or a regular expression.

    The regex is unanchored, like ``regexp_like``: it matches anywhere unless it starts with ``^``.
    """

    prefix3: tuple = ()
    prefix4: tuple = ()
    regex: str | None = None


# Code sets per topic.
ASTHMA_DEATH_CODES = CodeSet(prefix3=("J45", "J46", "493"), prefix4=("-493",))
ASTHMA_STAY_CODES = CodeSet(regex="J4[5-6]")
DIABETES_CODES = CodeSet(regex="E1[01234]")
DIABETES_KETO_CODES = CodeSet(regex="E101|E111|E121|E131|E141")
COPD_DEATH_CODES = CodeSet(regex="^J4[0-4]")
COPD_STAY_CODES = CodeSet(prefix3=("J40", "J41", "J42", "J43", "J44", "490", "491", "492", "496"),
                          prefix4=("-490", "-491", "-492", "-496"))
EPILEPSY_CODES = CodeSet(prefix3=("G40", "G41", "345"), prefix4=("-345",))
MS_CODES = CodeSet(prefix3=("G35", "340"), prefix4=("-340",))

# Allergy condition flags, in the order the report lists them.
ALLERGY_FLAGS = (
    ("conjunc", CodeSet(prefix4=("H101",))),
    ("rhinitis", CodeSet(prefix3=("J30", "J31"))),
    ("asthma", CodeSet(prefix3=("J45",), prefix4=("J450", "J46X"))),
    ("food_allergy", CodeSet(prefix4=("K522", "L272", "T781"))),
    ("dermatitis", CodeSet(prefix3=("L20", "L23"))),
    ("urticaria", CodeSet(prefix3=("L50",))),
    ("tox_ven", CodeSet(prefix4=("T634",))),
    ("anaphylaxis", CodeSet(prefix4=("T780", "T782", "T805", "T886"))),
    ("angio_oedema", CodeSet(prefix4=("T783",))),
    ("allergy_unspec", CodeSet(prefix3=("Z88",), prefix4=("T784",))),
    ("predom_asthma", CodeSet(prefix4=("J450",))),
    ("allergy", CodeSet(prefix3=("L20", "L23", "L50", "Z88"),
                        prefix4=("K522", "L272", "T781", "T634", "T780", "T782", "T805", "T886",
                                 "T783", "T784"))),
)
ALLERGY_SELECTION = CodeSet(prefix3=("J30", "J31", "J45", "L20", "L23", "L50", "Z88"),
                            prefix4=("H101", "J450", "J46X", "K522", "L272", "T781", "T634", "T780",
                                     "T782", "T805", "T886", "T783", "T784"))
# The multi-condition total adds the first ten flags (conjunc .. allergy_unspec).
ALLERGY_TOTAL_FLAGS = tuple(name for name, _ in ALLERGY_FLAGS[:10])
# Display names of the allergy types.
ALLERGY_LABELS = {
    "allergy": "One or more allergic conditions", "allergy_unspec": "Unspecified allergy",
    "anaphylaxis": "Anaphylaxis", "angio_oedema": "Angioneurotic Oedema", "asthma": "Asthma",
    "conjunc": "Conjuctivitis", "dermatitis": "Dermatitis", "food_allergy": "Food allergy",
    "predom_asthma": "Predominantly asthma", "rhinitis": "Rhinitis", "total": "All allergies",
    "tox_ven": "Toxic effect due to venom", "urticaria": "Urticaria",
}
# Sex codes and their labels.
SEX_LABELS = {"1": "Male", "2": "Female"}
VALID_SEXES = ("1", "2")
RESIDENT_COUNTRY = "XS"
EXCLUDED_BOARD_PREFIX = "S082"
SCOTLAND_CODE = "S00000001"


@dataclass(frozen=True)
class LookbackParams:
    gap_from: str = "dodis"          # 'dodis' (previous discharge) or 'doadm' (previous admission)
    min_gap_years: float = 10.0
    days_per_year: float = 365.0


# Causes-of-death report. Age columns dropped for the under-75 table, causes that
# are not shown (besides summary groups, whose names contain "."), the relabelled cause and the
# cause whose count is subtracted from another.
UNDER75_EXCLUDED_AGES = ("all_ages", "75-84", "85-89", "90+")
ALL_AGES_COLUMN = "all_ages"
TOTAL_CAUSE = "All causes"
EXCLUDED_CAUSES = ("Codes for special purposes", "Malignant neoplasms")
CAUSE_RELABEL = {"Poisonings": "Accidental poisonings including drug abuse"}
CAUSE_SUBTRACTION = ("Accidents", "Accidental poisonings including drug abuse")
TOP_CAUSES_N = 10
