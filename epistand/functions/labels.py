"""Value recoding and chart labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from epistand.params import SEX_LABELS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c, mapping: dict, keep_unmatched: bool = True) -> Column:
    """Replace values by a mapping. Unmatched values are kept (same type) or become NULL."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return c
    return expr.otherwise(c) if keep_unmatched else expr


def sex_label(c, keep_unmatched: bool = True) -> Column:
    """'1' -> Male, '2' -> Female; other codes are kept as they are (or NULL)."""
    return recode(_col(c).cast("string"), SEX_LABELS, keep_unmatched)
