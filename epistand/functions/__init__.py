"""Column builders: scalar expressions that stay inside whole-stage codegen (no Python UDFs)."""

from epistand.functions.ages import age_band, coarse_band, coarse_band_from_grp, epop_weight
from epistand.functions.codes import any_position_match, code_match
from epistand.functions.dates import fiscal_year, years_between, year_label
from epistand.functions.labels import recode, sex_label
from epistand.functions.text import clean_name, parse_count

__all__ = [
    "age_band", "coarse_band", "coarse_band_from_grp", "epop_weight", "any_position_match",
    "code_match", "fiscal_year", "years_between", "year_label", "recode", "sex_label",
    "clean_name", "parse_count",
]
