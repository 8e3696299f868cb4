"""Every rate with the count of cells that it leaves out for want of a denominator, in one pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession

from epistand.operators.cells import watch_denominators
from epistand.sources.readers import lineage_cut

AUDIT = "topic string, cells long, cells_without long, events_without long, rates long"


def audited(cells: DataFrame, rates_of: Callable[[DataFrame], DataFrame], name: str) -> tuple[DataFrame, tuple]:
    """The rates of ``cells``, computed and stored by one job, and that job's audit row
    (name, cells, cells_without, events_without, rates)."""
    audit = Observation(f"denominators-{name}-{uuid.uuid4().hex}")
    rates = lineage_cut(rates_of(watch_denominators(cells, audit)))
    n = rates.count()
    if n == 0:  # every cell is in some rate; the metrics of an empty plan may be optimised away
        return rates, (name, 0, 0, 0, 0)
    got = audit.get
    return rates, (name, got["cells"], got["cells_without"], got["events_without"], n)


def audit_table(spark: SparkSession, topics: dict[str, tuple[DataFrame, Callable]]) -> DataFrame:
    """One row per topic (name -> cells and the function that makes its rates)."""
    return spark.createDataFrame([audited(cells, rates, name)[1] for name, (cells, rates) in topics.items()], AUDIT)
