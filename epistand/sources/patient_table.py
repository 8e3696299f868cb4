"""A patient-bucketed base table: one layout that per-patient work reuses without another exchange.

The records of all sources are written once as one table, bucketed and sorted by patient. Stay
roll-ups, first records per patient-year, the residency filter and the look-back then run inside the
buckets. (One table with a source column, as a union of bucketed tables loses its partitioning once a
side adds a column.)

A bucket is read by one task, so a patient with a large share of all records must not be in one: the
records of patients with more than half an average bucket are kept aside in a plain table, and the
caller's work runs on these with its ordinary exchanges. There are fewer than two such patients for
each bucket, whatever the data, so the list that splits them off is broadcast. The missing patient
(NULL), if there are records of it, is always one of them.

Whole records are exchanged once, by patient. The area of a postcode is looked up for the distinct
postcodes of each patient, which the same pass over the records finds that counts them, and comes
back to the records inside the partitions of that one exchange. These cut a bucket into parts of
about ``TASK_ROWS`` records (one file each), and the steps before have as many tasks, so that what a
task sorts or buffers doesn't grow with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistand.session import ensure_checkpoint_dir

BUCKET_ROWS = 2_000_000  # records an average bucket holds
MIN_BUCKETS = 8
TASK_ROWS = 250_000  # records an average task of the write holds
COUNT_BYTES = 8 << 20  # shuffled bytes of the narrow rows that a counting task reads
LEAST_ASIDE = 1000  # a patient with fewer records is never kept aside, the missing one apart


def fingerprint(spark: SparkSession, paths: list[str], *parameters) -> str:
    """Hash of the input files (path, length, time of change; contents are not read) and parameters."""
    files = (spark.read.format("binaryFile").load(paths).select("path", "length", F.unix_micros("modificationTime").alias("at")))
    total = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "at").cast("decimal(38,0)")),
                      F.sum(F.xxhash64("at", "length", "path").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((*total, *parameters)).encode()).hexdigest()[:32]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def drop_superseded(spark: SparkSession, prefix: str, keep: str) -> list[str]:
    """Delete the folders of the checkpoint folder that begin with ``prefix``, but for ``keep``."""
    fs, root = _fs(spark, ensure_checkpoint_dir(spark))
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(prefix) and name != keep:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone


@dataclass(frozen=True)
class PatientTable:
    """``light``: the bucketed table; ``heavy``: the records of the patients kept aside, or None."""

    light: DataFrame
    heavy: DataFrame | None
    buckets: int
    folder: str

    def per_patient(self, work: Callable[[DataFrame], DataFrame],
                    heavy_work: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """``work`` on the bucketed records and, where there are patients aside, ``heavy_work`` (or
        ``work``) on theirs. Exact for any work that never looks across patients."""
        out = work(self.light)
        return out if self.heavy is None else out.unionByName((heavy_work or work)(self.heavy))


@contextmanager
def settings(spark: SparkSession, **values) -> Iterator[None]:
    """Jobs run inside have these settings of ``spark.sql`` (``__`` for a dot)."""
    names = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def areas(lookup: DataFrame, key: str = "pc7", zone: str = "datazone2011") -> DataFrame:
    """(_pc, zone) of every postcode with an area; one listed with an area more than once stops the job,
    as it would duplicate records."""
    once = lookup.where(F.col(zone).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.any_value(zone).alias("z"))
    repeated = F.raise_error(F.concat(F.lit(f"{key} listed more than once: "), F.col(key).cast("string")))
    return once.select(F.col(key).alias("_pc"), F.when(F.col("n") > 1, repeated).otherwise(F.col("z")).alias("zone"))


def with_area(records: DataFrame, lookup: DataFrame) -> DataFrame:
    """Records with ``zone``, the area of their postcode (NULL: not resident); see ``areas``."""
    return records.join(areas(lookup), F.col("dr_postcode") == F.col("_pc"), "left").drop("_pc")


def _table(path: str) -> str:
    return "epistand_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _open(spark: SparkSession, path: str, buckets: int, order: str) -> DataFrame:
    """The bucketed table in ``path``, registered in this session's catalogue if it isn't."""
    if not spark.catalog.tableExists(_table(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {_table(path)} ({columns}) USING parquet CLUSTERED BY (link_no) SORTED BY (link_no, {order}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_table(path))


def _with_area_inside(records: DataFrame, places: DataFrame, lookup: DataFrame, parts: int) -> DataFrame:
    """``with_area`` of records of known patients, which are then in ``parts`` partitions by patient.

    ``places`` has each patient's postcodes: few rows beside the records, so the look-up by postcode
    moves these, and both sides then meet by patient."""
    found = places.where("link_no is not null").join(areas(lookup), F.col("dr_postcode") == F.col("_pc"))
    found = found.select("link_no", "dr_postcode", "zone").repartition(parts, "link_no").hint("shuffle_hash")
    joined = records.repartition(parts, "link_no").join(found, ["link_no", "dr_postcode"], "left")
    return joined.select(*records.columns, "zone")


def patient_table(spark: SparkSession, records: DataFrame, key: str, order: str = "admission_date",
                  buckets: int | None = None, name: str = "patients", lookup: DataFrame | None = None) -> PatientTable:
    """``records`` (with ``link_no``) bucketed by patient under the shared checkpoint folder; with
    ``lookup``, as ``with_area`` would give them.

    ``key`` names the inputs' state (``fingerprint``): a table already written for it is reused, and
    tables of ``name`` for other states are deleted after this one stands. A run that fails leaves no
    finished table, and the next one writes it anew. NULL patients are one patient."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    done = f"base-{name}-{key}"
    folder = f"{root}/{done}"
    if not folder_exists(spark, f"{folder}/layout/_SUCCESS"):
        by = ["link_no"] if lookup is None else ["link_no", "dr_postcode"]
        with settings(spark, adaptive__advisoryPartitionSizeInBytes=COUNT_BYTES):
            records.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{folder}/places")
            places = spark.read.parquet(f"{folder}/places")
            rows = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            n = buckets or max(MIN_BUCKETS, -(-rows // BUCKET_ROWS))
            per = places.groupBy("link_no").agg(F.sum("n").alias("n"))
            large = (F.col("n") * 2 * n > rows) & (F.col("n") > LEAST_ASIDE)
            per.where(large | F.col("link_no").isNull()).select(F.col("link_no").alias("_aside")).write.mode("overwrite").parquet(f"{folder}/aside")
        aside = spark.read.parquet(f"{folder}/aside")
        some = aside.limit(1).count()
        # a multiple of the buckets: the records of a partition are all of one bucket
        parts = n * max(1, -(-rows // (n * TASK_ROWS)))
        with settings(spark, shuffle__partitions=parts, adaptive__coalescePartitions__enabled="false"):
            if some:
                same = F.col("link_no").eqNullSafe(F.col("_aside"))
                # the missing patient and fewer than two patients a bucket: each has more than rows / (2 * n) records
                heavy = records.join(F.broadcast(aside), same, "left_semi")
                heavy = heavy if lookup is None else with_area(heavy, lookup)
                heavy.write.mode("overwrite").parquet(f"{folder}/heavy")
                records = records.join(F.broadcast(aside), same, "left_anti")
            path = f"{folder}/light"
            spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
            light = records.repartition(parts, "link_no") if lookup is None else _with_area_inside(records, places, lookup, parts)
            (light.write.format("parquet").mode("overwrite").option("path", path)
             .bucketBy(n, "link_no").sortBy("link_no", order).saveAsTable(_table(path)))
        layout = spark.createDataFrame([(n, bool(some))], "buckets int, some_aside boolean")
        layout.coalesce(1).write.mode("overwrite").parquet(f"{folder}/layout")
    layout = spark.read.parquet(f"{folder}/layout").first()
    drop_superseded(spark, f"base-{name}-", done)
    light = _open(spark, f"{folder}/light", layout["buckets"], order)
    return PatientTable(light, spark.read.parquet(f"{folder}/heavy") if layout["some_aside"] else None, layout["buckets"], folder)
