"""Readers: Parquet tables, a warehouse query over JDBC, CSV with several NA tokens, sections of
published text tables, and lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epistand.functions.text import clean_name
from epistand.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet read; with a schema only its columns are read, cast to its types."""
    df = spark.read.parquet(path)
    if schema is not None:
        from epistand.sources.schemas import conform
        df = conform(df, schema)
    return df


def read_warehouse(spark: SparkSession, url: str, query: str, properties: dict,
                   predicates: list[str]) -> DataFrame:
    """A query pushed to a warehouse over JDBC, read in parallel slices (one per predicate).

    The extraction steps of the method are written as DataFrame code, so the same plan can run on
    this reader or on Parquet; Spark pushes column pruning and simple filters into the query."""
    if not predicates:
        raise ValueError("give at least one predicate: each is read as one slice of the query")
    return spark.read.jdbc(url, f"({query}) q", predicates=predicates, properties=properties)


def clean_names(df: DataFrame) -> DataFrame:
    """Lower/snake-case every column name."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def read_csv_na(spark: SparkSession, path: str, schema: T.StructType,
                na_tokens=("", " ", "NA")) -> DataFrame:
    """CSV with a header where several tokens mean missing (Spark's nullValue takes one)."""
    raw = (spark.read.option("header", True).schema(
        T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path))
    return raw.select(*[
        F.when(F.col(f.name).isin(list(na_tokens)), None).otherwise(F.col(f.name)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file under ``path`` as (release, line_no, value), line_no from 1.

    Each published file is small (one table), so it is read whole and split; many releases are
    read in parallel, one file per task."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("release"))
    return (files.select("release", F.posexplode(F.split("value", r"\r?\n")).alias("pos", "value"))
            .select("release", (F.col("pos") + 1).alias("line_no"), "value"))


def lineage_cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Materialise a frame that several outputs reuse.

    With a path the frame is written as Parquet in the shared checkpoint folder and read back
    (survives executor loss, like a saved base file); without one, a reliable ``checkpoint()``."""
    spark = df.sparkSession
    if path is None:
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
