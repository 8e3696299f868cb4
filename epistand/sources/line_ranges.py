"""Text files read in byte ranges, with line numbers, and the fill-down over ranges of lines.

A file of any size is read by many tasks. Spark gives each range's lines in file order; their numbers
follow from the line counts of the ranges before. Blank cells are filled from the rows above by a
segmented scan: inside a segment of lines by a window, and from earlier segments by the last value of
every column in each of them, one row a segment.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epistand.session import ensure_checkpoint_dir

SEGMENT_LINES = 100_000


def numbered_lines(spark: SparkSession, path: str, release: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """Every line of every file under ``path`` as (release, line_no, value), line_no from 1.

    ``release`` names a folder column (``release=.../``), by default the file's path. Ranges are Spark's
    (``spark.sql.files.maxPartitionBytes``) unless ``range_bytes`` sets their size. The lines are
    written once with their place in the range, to the shared checkpoint folder; line numbers then
    need one row for each range."""
    reader = spark
    if range_bytes is not None:
        reader = spark.newSession()  # its own settings, same cluster
        reader.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    lines = reader.read.text(path)
    which = F.col(release).cast("string") if release else F.col("_metadata.file_path")
    lines = lines.select(which.alias("release"), F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.file_block_start").alias("_range"), F.monotonically_increasing_id().alias("_at"), "value")
    placed = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    lines.write.parquet(placed)
    lines = spark.read.schema(lines.schema).parquet(placed)
    ranges = lines.groupBy("_file", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_file", "_range", (F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return (lines.join(ranges, ["_file", "_range"])
            .select("release", (F.col("_at") + F.col("_shift")).cast("int").alias("line_no"), "value"))


def fill_down_ranges(df: DataFrame, cols, partition: str, order: str, segment: int = SEGMENT_LINES) -> DataFrame:
    """``fill_down`` (last value carried forward per ``partition`` in ``order``, integers) without a window
    over a whole partition: segments are ``segment`` consecutive values of ``order``.

    The carry between segments is a running combination of each segment's last values, one row a
    segment. NULL ``order`` values come first, as in the window form."""
    names = [c for c in df.columns if c in set(cols)]
    df = df.withColumn("_segment", F.coalesce(F.floor(F.col(order) / segment), F.lit(-(1 << 62))).cast("long"))
    # equal places don't occur: one row a line; a NULL place ranks before all
    place = F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 62)))
    ends = df.groupBy(partition, "_segment").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_carry{i}") for i, c in enumerate(names)])
    earlier = Window.partitionBy(partition).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(F.col(partition).alias("_p"), F.col("_segment").alias("_s"),
                        *[F.last(f"_carry{i}", ignorenulls=True).over(earlier).alias(f"_carry{i}") for i in range(len(names))])
    joined = df.join(carry, F.col(partition).eqNullSafe(F.col("_p")) & (F.col("_segment") == F.col("_s")))
    inside = Window.partitionBy(partition, "_segment").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(inside), F.col(f"_carry{i}")) for i, c in enumerate(names)}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns if c != "_segment"])
