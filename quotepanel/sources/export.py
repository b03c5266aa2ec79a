"""CSV export of the period panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotepanel.operators.names import labelled
from quotepanel.operators.period import DEFAULT_PERIOD, period


def export_frame(panel: DataFrame, selected: list[str] | None = None, n: int | None = DEFAULT_PERIOD) -> DataFrame:
    """Period rows of the selected codes, or of all when none is selected."""
    rows = period(panel, n)
    if selected:
        rows = rows.filter(F.col("cur_unit").isin(selected))
    return labelled(rows)


def export_panel(
    panel: DataFrame, path: str, selected: list[str] | None = None, n: int | None = DEFAULT_PERIOD
) -> None:
    """Write the export as CSV part files with a header, UTF-8 without BOM."""
    export_frame(panel, selected, n).write.mode("overwrite").option("header", True).csv(path)
