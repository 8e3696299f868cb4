"""Write the outputs of a topic plan as chart files (one CSV per output, overwritten)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from epistand.sources.sinks import write_chart_csv

# Written columns and row order of the charts that declare them; None keeps all columns.
LAYOUTS: dict[str, tuple[tuple[str, ...] | None, tuple[str, ...]]] = {
    "top10causes_chart1": (("class1", "measure"), ("measure", "class1")),
    "top10causes_chart2": (("class1", "measure"), ("measure", "class1")),
    "incidence_agesex_chart_1": (None, ("sex", "agegrp", "year")),
    "seccare_chart1_pra": (None, ("class1", "class2")),
    "seccare_chart2_pra": (None, ("class1", "class2")),
}


def layout_of(name: str, df: DataFrame, layouts: dict | None = None) -> tuple[list, list, list]:
    """Written columns, sort keys and folder columns of an output; names that it lacks are left out."""
    columns, keys = (LAYOUTS if layouts is None else layouts).get(name, (None, tuple(df.columns)))
    by = ["release"] if columns and "release" in df.columns else []
    return [c for c in columns or df.columns if c in df.columns], [k for k in keys if k in df.columns], by


def publish(outputs: dict[str, DataFrame], folder: str, layouts: dict | None = None) -> list[str]:
    """Each output is a chart table of tens of rows, written as one CSV.

    ``layouts`` (default ``LAYOUTS``) gives an output's columns and sort keys; names that the
    output lacks are left out. A table of several releases is written as one folder per release
    (``name/release=...``), each in chart order. Other outputs are sorted by their columns.
    Returns the written paths. ``sources.publication`` does this with versions and a manifest."""
    paths = []
    for name, df in outputs.items():
        keep, keys, by = layout_of(name, df, layouts)
        path = os.path.join(folder, name)
        write_chart_csv(df.select(*by, *dict.fromkeys([*keep, *keys])), path, order_by=keys, columns=keep, split_by=by)
        paths.append(path)
    return paths
