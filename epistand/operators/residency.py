"""Residency filters: by a postcode -> area lookup, or by columns on the record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epistand.params import EXCLUDED_BOARD_PREFIX, RESIDENT_COUNTRY


def resident_by_lookup(df: DataFrame, lookup: DataFrame, key: str = "pc7",
                       zone: str = "datazone2011", keep_zone: bool = False,
                       drop_key: bool = True) -> DataFrame:
    """Keep records whose postcode maps to an area (left join + IS NOT NULL == semi/inner join).

    Without ``keep_zone`` this is a left-semi join: a postcode listed twice can never duplicate
    records. With ``keep_zone`` a postcode listed with an area more than once stops the job, as it would duplicate
    records. The lookup is not hinted: AQE measures it at run time and broadcasts it only when it
    is under the broadcast bound, otherwise both sides are shuffled on the postcode."""
    resident = lookup.where(F.col(zone).isNotNull()).select(key, zone)
    if keep_zone:
        once = resident.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.any_value(zone).alias(zone))
        repeated = F.raise_error(F.concat(F.lit(f"{key} listed more than once: "), F.col(key).cast("string")))
        out = df.join(once.select(key, F.when(F.col("n") > 1, repeated).otherwise(F.col(zone)).alias(zone)), on=key, how="inner")
    else:
        out = df.join(resident.select(key), on=key, how="left_semi")
    return out.drop(key) if drop_key else out


def resident_by_country(df: DataFrame, col: str = "country_of_residence",
                        country: str = RESIDENT_COUNTRY) -> DataFrame:
    return df.where(F.col(col) == F.lit(country))


def treated_in_board(df: DataFrame, col: str = "hbtreat_currentdate",
                     excluded_prefix: str | None = EXCLUDED_BOARD_PREFIX) -> DataFrame:
    """Treatment board recorded, optionally excluding one board by its code prefix."""
    out = df.where(F.col(col).isNotNull())
    if excluded_prefix:
        out = out.where(F.substring(col, 1, len(excluded_prefix)) != F.lit(excluded_prefix))
    return out


def distinct_key_violations(lookup: DataFrame, key: str = "pc7") -> DataFrame:
    """Keys listed more than once (an inner join on them would duplicate records)."""
    return lookup.groupBy(key).count().where(F.col("count") > 1)
