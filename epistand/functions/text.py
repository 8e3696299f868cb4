"""Text helpers: column-name cleaning and parsing of published counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """Lower/snake-case a column name (runs on the driver over names only, never over data)."""
    s = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip())
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return s.strip("_").lower()


def parse_count(c) -> Column:
    """Published count text -> double: '-' is zero, thousands separators are removed, anything
    unparsable becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    c = F.when(c == "-", F.lit("0")).otherwise(c)
    return F.regexp_replace(c, ",", "").try_cast("double")
