"""Reshaping: wide -> long, empty-row removal, fill-down, and reading a published text table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unpivot_all_but(df: DataFrame, ids, var: str, value: str, value_type: str | None = None) -> DataFrame:
    """Every column except ``ids`` becomes a (name, value) row; NULL values are kept."""
    values = [c for c in df.columns if c not in ids]
    if value_type:
        df = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in values])
    return df.unpivot(list(ids), values, var, value)


def fill_down(df: DataFrame, cols, partition: str, order: str) -> DataFrame:
    """Last observation carried forward, per partition (one published file) in line order."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def empty_line(columns: int) -> str:
    """Regex of a CSV line whose first ``columns`` fields are all blank or NA."""
    f = r'\s*"?\s*(?:NA)?\s*"?\s*'
    return rf"^{f}(?:(?:,{f}){{0,{columns - 1}}}|(?:,{f}){{{columns - 1}}},.*)$"


def read_sections(lines: DataFrame, sections, names, release: str = "release") -> DataFrame:
    """Parse line ranges of text lines (release, line_no, value) as CSV rows with ``names``.

    ``sections`` is a list of (skip, n_max, drop_empty): lines skip+1 .. skip+n_max are parsed;
    with drop_empty, lines whose read fields are all empty are removed (tested on the raw text, which
    keeps the optimizer from reasoning over a predicate on every parsed column). Rows keep
    (release, line_no) so that later steps can restore file order without a global sort.
    Blank and NA fields are NULL; fields beyond ``names`` are not read."""
    ddl = ", ".join(f"c{i} string" for i in range(len(names)))
    keep = None
    for skip, n_max, drop_empty in sections:
        cond = F.col("line_no").between(skip + 1, skip + n_max)
        if drop_empty:
            cond = cond & ~F.col("value").rlike(empty_line(len(names)))
        keep = cond if keep is None else keep | cond
    # One parse per line: inline(array(struct)) yields every field; selecting r.c0 .. r.cN instead
    # lets the optimizer split the parse into one single-field parser per column.
    return (lines.where(keep)
            .select(release, "line_no", F.inline(F.array(F.from_csv("value", ddl))))
            .select(release, "line_no", *[F.when(~F.trim(F.col(f"c{i}")).isin("", "NA"), F.col(f"c{i}")).alias(n)
                                          for i, n in enumerate(names)]))


def clean_published_counts(table: DataFrame, id_cols, count_cols, release: str = "release",
                           var: str = "age", value: str = "num_deaths", fill=fill_down) -> DataFrame:
    """Fill blanks down every column, unpivot the count columns, parse the counts. ``fill`` may be
    ``fill_down_ranges`` for tables too long for one window."""
    from epistand.functions.text import parse_count
    filled = fill(table, [c for c in table.columns if c not in (release, "line_no")], release, "line_no")
    long = filled.unpivot([release, "line_no", *id_cols], list(count_cols), var, value)
    return long.withColumn(value, parse_count(value))
