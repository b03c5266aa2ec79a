"""The stored layers as an analyst reads them: one state, look-ups from the kept tables.

Latest date, period bounds, histories, completeness, missing days and names
come from ``dates`` and ``codes``, a row per date or per bucket and code; only
the rows that are asked for are read from the mart.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from quotepanel.functions.dates import on
from quotepanel.operators import ops, period
from quotepanel.operators.period import DEFAULT_CODES, DEFAULT_PERIOD
from quotepanel.operators.state import names_of
from quotepanel.sources.layers import Layers, State


class StoredPanel:
    """The layers as of one state; later loads do not change what it reads."""

    def __init__(self, layers: Layers, state: State | None = None):
        self.layers = layers
        self.state = state or layers.state()

    def _read(self, layer: str) -> DataFrame:
        return self.layers.read(layer, state=self.state)

    @cached_property
    def mart(self) -> DataFrame:
        return self._read("mart")

    @cached_property
    def dates(self) -> DataFrame:
        """One row per date: rows, updated_at."""
        return self._read("dates")

    @cached_property
    def codes(self) -> DataFrame:
        """One row per bucket and code."""
        return self._read("codes")

    @cached_property
    def names(self) -> DataFrame:
        """cur_unit, cur_nm: the name dimension."""
        return names_of(self.codes)

    def enriched(self, rows: DataFrame | None = None) -> DataFrame:
        """The mart, or given rows of it, with names; STAGING is not read."""
        return (self.mart if rows is None else rows).join(self.names, "cur_unit", "left")

    def period(self, n: int | None = DEFAULT_PERIOD) -> DataFrame:
        return period.period(self.mart, n, among=self.dates)

    def snapshot(self) -> DataFrame:
        return on(self.mart, self.dates.agg(F.max("result_date")).scalar())

    def selected(self, codes: list[str] | None = None, n: int | None = DEFAULT_PERIOD, defaults: list[str] = DEFAULT_CODES) -> DataFrame:
        """Rows of the selected or default codes in the period."""
        return period.select(self.period(n), codes, defaults, among=self.codes)

    def latest(self) -> DataFrame:
        return period.latest(self.dates)

    def recent_dates(self, n: int) -> DataFrame:
        return period.recent_dates(self.dates, n)

    def history(self, days: int | None = ops.HISTORY_DATES) -> DataFrame:
        return ops.history(self.mart, days, self.dates, self.codes)

    def completeness(self) -> DataFrame:
        return ops.completeness(self.mart, self.dates, self.codes)

    def missing_weekdays(self) -> DataFrame:
        return ops.missing_weekdays(self.dates)

    def ops(self) -> DataFrame:
        return ops.ops(self.mart, self.dates, self.codes)

    def freshness(self, as_of) -> DataFrame:
        return ops.freshness(self.dates, as_of)
