"""Atomic publication: outputs are staged, checked against a manifest and put in force by one rename.

A publication is a folder of versions and a pointer file. Outputs are written to a new version, the
row count and a checksum of each are taken while it is written and stored in the version's manifest,
and the pointer is replaced last, by a rename that overwrites. A run that fails anywhere before leaves
the earlier version in force; readers resolve the pointer once and see one version throughout.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epistand.plans.publish import layout_of
from epistand.sources.sinks import write_chart_csv

POINTER = "CURRENT"
MANIFEST = "manifest.json"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _context(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    out = _fs(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def current(spark: SparkSession, folder: str) -> str | None:
    """Folder of the version in force, or None before the first publication."""
    pointer = f"{folder.rstrip('/')}/{POINTER}"
    if not _fs(spark, pointer).exists(_path(spark, pointer)):
        return None
    return f"{folder.rstrip('/')}/{_read_text(spark, pointer).strip()}"


def manifest(spark: SparkSession, folder: str) -> dict:
    """Outputs of the version in force: name -> rows, checksum, columns, order."""
    version = current(spark, folder)
    return json.loads(_read_text(spark, f"{version}/{MANIFEST}")) if version else {}


def checksum(df: DataFrame) -> F.Column:
    """Order-free checksum of all rows' values as text (repeated rows count each)."""
    return F.sum(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in df.columns]).cast("decimal(38,0)")).cast("string")


def publish_version(outputs: dict[str, DataFrame], folder: str, layouts: dict | None = None, keep: int = 2) -> dict:
    """Write every output as chart CSV (columns and order of ``layouts``, as ``publish``) into a new
    version of ``folder``, put it in force and return its manifest. ``keep`` versions are kept.

    The written files are read back before the pointer moves: rows, header and checksum have to be
    those seen while writing. Equal outputs give equal manifests."""
    spark = next(iter(outputs.values())).sparkSession
    folder = folder.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    entries = {}
    for name, df in sorted(outputs.items()):
        columns, keys, by = layout_of(name, df, layouts)
        seen = Observation(f"publish-{name}-{uuid.uuid4().hex}")
        kept = df.select(*by, *dict.fromkeys([*columns, *keys]))
        written = kept.select(*by, *columns)
        kept = kept.observe(seen, F.count(F.lit(1)).alias("rows"), checksum(written).alias("sum"))
        path = f"{folder}/{version}/{name}"
        write_chart_csv(kept, path, order_by=keys, columns=columns, split_by=by)
        got = _metrics(seen)
        entries[name] = {"rows": got["rows"], "checksum": got["sum"], "columns": [*by, *columns], "order": keys}
        check_written(spark, path, entries[name], written)
    _write_text(spark, f"{folder}/{version}/{MANIFEST}", json.dumps(entries, indent=1, sort_keys=True))
    before = current(spark, folder)
    staged = f"{folder}/{POINTER}.{version}"
    _write_text(spark, staged, version)
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    _context(spark, folder).rename(_path(spark, staged), _path(spark, f"{folder}/{POINTER}"), overwrite)
    _drop_old(spark, folder, {version, (before or "").rsplit("/", 1)[-1]} if keep > 1 else {version})
    return entries


def _metrics(seen: Observation) -> dict:
    """Metrics of a finished write; Spark has none where it found the output to be empty while planning."""
    try:
        return seen.get
    except Py4JJavaError:
        return {"rows": 0, "sum": None}


def check_written(spark: SparkSession, path: str, entry: dict, like: DataFrame) -> None:
    """Raise unless the files under ``path`` hold the entry's rows, header and values."""
    back = spark.read.option("header", True).option("nullValue", "NA").csv(path)
    if not entry["rows"]:
        if back.limit(1).count():
            raise ValueError(f"{path}: written rows differ from the ones computed")
    else:
        if sorted(back.columns) != sorted(entry["columns"]):
            raise ValueError(f"{path}: header {back.columns} instead of {entry['columns']}")
        got = back.select(*like.columns).agg(F.count(F.lit(1)).alias("rows"), checksum(like).alias("sum")).first()
        if (got["rows"], got["sum"]) != (entry["rows"], entry["checksum"]):
            raise ValueError(f"{path}: written rows differ from the ones computed")


def _drop_old(spark: SparkSession, folder: str, keep: set[str]) -> None:
    fs = _fs(spark, folder)
    for status in fs.listStatus(_path(spark, folder)):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in keep:
            fs.delete(status.getPath(), True)


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An output of the version in force; all columns as text, NA as NULL."""
    version = current(spark, folder)
    if version is None:
        raise ValueError(f"nothing published in {folder}")
    return spark.read.option("header", True).option("nullValue", "NA").csv(f"{version}/{name}")
