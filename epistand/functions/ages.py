"""Age columns: five-year bands, EPOP weights and the coarse bands charts report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from epistand.params import AGE_BAND_COUNT, AGE_BAND_MAX_AGE, EPOP_WEIGHTS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_band(age) -> Column:
    """Five-year band 1..19 (0-4 -> 1, ..., 85-89 -> 18, 90-200 -> 19); NULL outside 0..200."""
    age = _col(age)
    band = F.least(F.floor(age / 5).cast("int") + 1, F.lit(AGE_BAND_COUNT))
    return F.when(age.between(0, AGE_BAND_MAX_AGE), band).cast("int")


def epop_weight(age_grp) -> Column:
    """European Standard Population weight of a five-year band; NULL for any other value."""
    weights = F.array(*[F.lit(float(w)) for w in EPOP_WEIGHTS])
    g = _col(age_grp)
    return F.when(g.between(1, AGE_BAND_COUNT), F.try_element_at(weights, g.cast("int")))


def coarse_band(age, bands) -> Column:
    """Coarse band label from the age in years, using each band's age limits."""
    age = _col(age)
    expr = None
    for b in bands:
        cond = F.lit(True)
        if b.min_age is not None:
            cond = cond & (age >= b.min_age)
        if b.max_age is not None:
            cond = cond & (age <= b.max_age)
        expr = F.when(cond, F.lit(b.label)) if expr is None else expr.when(cond, F.lit(b.label))
    return expr


def coarse_band_from_grp(age_grp, bands) -> Column:
    """Coarse band label from the five-year band, using each band's first and last band."""
    g = _col(age_grp)
    expr = None
    for b in bands:
        cond = g.between(b.first_grp, b.last_grp)
        expr = F.when(cond, F.lit(b.label)) if expr is None else expr.when(cond, F.lit(b.label))
    return expr


def band_epop_total(band_col, bands) -> Column:
    """The EPOP total of the coarse band a row belongs to (sum of its five-year weights)."""
    c = _col(band_col)
    expr = None
    for b in bands:
        cond = c == F.lit(b.label)
        val = F.lit(float(b.epop_total))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr
