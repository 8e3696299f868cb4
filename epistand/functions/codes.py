"""Clinical code predicates: prefix lists, regular expressions and any-position matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from epistand.params import CodeSet


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_match(code, codes: CodeSet) -> Column:
    """True when the code's first 3 characters are in prefix3, its first 4 in prefix4, or the
    regex matches (unanchored unless the pattern starts with ``^``). NULL code -> NULL."""
    c = _col(code)
    parts = []
    if codes.prefix3:
        parts.append(F.substring(c, 1, 3).isin(list(codes.prefix3)))
    if codes.prefix4:
        parts.append(F.substring(c, 1, 4).isin(list(codes.prefix4)))
    if codes.regex:
        parts.append(c.rlike(codes.regex))
    if not parts:
        raise ValueError("empty code set")
    return reduce(lambda a, b: a | b, parts)


def any_position_match(cols, codes: CodeSet) -> Column:
    """Match over the concatenation of several code columns, NULLs skipped (``'a' || NULL`` = 'a').

    Like the warehouse query this matches the unseparated concatenation, so a pattern can span a
    code boundary."""
    joined = F.concat_ws("", *[_col(c) for c in cols])
    return code_match(joined, codes)


def match_flag(code, codes: CodeSet) -> Column:
    """1 when the code matches, else 0 (NULL codes give 0)."""
    return F.when(code_match(code, codes), F.lit(1)).otherwise(F.lit(0))
