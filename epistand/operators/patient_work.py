"""Work inside patient buckets: roll-ups that carry the area and take deaths along."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epistand.functions.dates import fiscal_year
from epistand.operators.extract import SOURCE_RANK

IS_DEATH = "source_rank = 0"


def all_records(episodes: DataFrame, historic: DataFrame, deaths: DataFrame) -> DataFrame:
    """Episodes of both tables and deaths as one table with ``source_rank``.

    A death has its registration date as admission and discharge date, its age and sex in the episode
    columns, and ``record_no``, which keeps it apart from other deaths (NULL for episodes)."""
    tagged = lambda df, source: df.withColumn("source_rank", F.lit(SOURCE_RANK[source]))
    d = deaths.withColumnsRenamed({"age": "age_in_years", "date_of_registration": "admission_date"})
    d = d.withColumns({"discharge_date": F.col("admission_date"), "record_no": F.monotonically_increasing_id()})
    return (tagged(episodes, "current").unionByName(tagged(historic, "historic"))
            .unionByName(tagged(d, "deaths"), allowMissingColumns=True))


def _place() -> Column:
    """The smallest postcode with its area, as ``min(dr_postcode)`` followed by the lookup would give."""
    return F.min(F.when(F.col("dr_postcode").isNotNull(), F.struct(F.col("dr_postcode").alias("pc7"), "zone"))).alias("_place")


def events_with_area(records: DataFrame) -> DataFrame:
    """One row per stay of each source (as ``stay_rollup``) and one per death, with the area."""
    out = records.groupBy(F.col("link_no").alias("linkno"), F.col("cis_marker").alias("cis"), "source_rank", "record_no").agg(
        F.max("age_in_years").alias("age"), F.min("admission_date").alias("doadm"), F.max("discharge_date").alias("dodis"),
        F.max("sex").alias("sex"), _place(), F.max(fiscal_year("admission_date")).alias("year"))
    return out.select("linkno", "cis", "source_rank", "age", "doadm", "dodis", "sex", F.col("_place.pc7").alias("pc7"), "year",
                      F.col("_place.zone").alias("zone"))


def first_with_area(episodes: DataFrame, date_col: str = "admission_date") -> DataFrame:
    """``first_per_patient_year`` of records with ``zone``: its columns and the area."""
    out = episodes.groupBy(F.col("link_no").alias("linkno"), fiscal_year(date_col).alias("year")).agg(
        F.min("age_in_years").alias("age"), F.min("sex").alias("sex"), _place())
    return out.select("linkno", "year", "age", "sex", F.col("_place.pc7").alias("pc7"), F.col("_place.zone").alias("zone"))


def residents(rows: DataFrame) -> DataFrame:
    """Rows whose postcode lies in an area; no join, as the area was looked up when the table was
    written. Deaths, which are selected by country, stay."""
    resident = F.col("zone").isNotNull()
    if "source_rank" in rows.columns:
        resident |= F.expr(IS_DEATH)
    return rows.where(resident).drop("pc7", "zone")
