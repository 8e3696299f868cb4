"""Typed CSV with a table of rejects: no bad value becomes a silent NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA_TOKENS = ("", " ", "NA")
BAD_ROW = "_row"  # reject of a line with another number of fields


def read_checked(spark: SparkSession, path: str, schema: T.StructType, na_tokens=NA_TOKENS) -> DataFrame:
    """The CSV files under ``path`` (with header) as ``schema``, plus ``_rejects``: for each value that is
    neither missing nor of its column's type, (column, value); for a line that doesn't hold one field a
    column, (``_row``, the line) and NULL in all columns.

    One pass; the parse is stored with the row, so values and rejects need no second read."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
           .schema(T.StructType([*fields, T.StructField("_corrupt", T.StringType())])).csv(path))
    clean = {f.name: F.when(F.col("_corrupt").isNull() & ~F.col(f.name).isin(*na_tokens), F.col(f.name)) for f in schema.fields}
    typed = {f.name: clean[f.name].try_cast(f.dataType) for f in schema.fields}
    reject = lambda name, value: F.struct(F.lit(name).alias("column"), value.alias("value"))
    bad = [F.when(clean[n].isNotNull() & typed[n].isNull(), reject(n, clean[n])) for n in clean]
    bad.append(F.when(F.col("_corrupt").isNotNull(), reject(BAD_ROW, F.col("_corrupt"))))
    return raw.select(*[typed[n].alias(n) for n in typed], F.array_compact(F.array(*bad)).alias("_rejects"))


def accepted(checked: DataFrame, required=()) -> DataFrame:
    """Rows without a reject in any column (or only in columns outside ``required``, if that is given)."""
    return checked.where(~_any(required)).drop("_rejects")


def _any(required) -> Column:
    return F.exists("_rejects", lambda r: r["column"].isin(BAD_ROW, *required)) if required else F.size("_rejects") > 0


def rejects(checked: DataFrame) -> DataFrame:
    """(column, value, n): every rejected value and how often it occurs."""
    return (checked.select(F.explode("_rejects").alias("r")).groupBy(F.col("r.column").alias("column"), F.col("r.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def reject_counts(checked: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: rows, rows with a reject, and the rejects of each column (``bad_<column>``) and of whole lines."""
    per = lambda name: F.coalesce(F.sum(F.size(F.filter("_rejects", lambda r: r["column"] == name))), F.lit(0)).cast("long")
    return checked.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_rejects") > 0).alias("rejected"),
                       *[per(f.name).alias(f"bad_{f.name}") for f in schema.fields], per(BAD_ROW).alias("bad_lines"))
