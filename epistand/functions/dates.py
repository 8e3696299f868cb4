"""Date columns: fiscal year (April-March), day gaps in years, year labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(d) -> Column:
    """Fiscal year labelled by its starting calendar year: April..December -> year, else year-1."""
    d = _col(d)
    return (F.year(d) - F.when(F.month(d) > 3, F.lit(0)).otherwise(F.lit(1))).cast("int")


def years_between(later, earlier, days_per_year: float = 365.0) -> Column:
    """Gap in days divided by a fixed year length (365 exactly, as the method uses)."""
    return F.datediff(_col(later), _col(earlier)).cast("double") / F.lit(float(days_per_year))


def year_label(y, year_type: str = "financial") -> Column:
    """'2019' -> '2019/20' for financial years; the plain year as text for calendar years."""
    y = _col(y)
    if year_type == "financial":
        return F.concat(y.cast("string"), F.lit("/"), F.substring((y + 1).cast("string"), 3, 2))
    if year_type == "calendar":
        return y.cast("string")
    raise ValueError(f"unknown year_type {year_type!r}")
