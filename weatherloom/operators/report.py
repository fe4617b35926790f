"""Row order of the published tables; sorting belongs to the last step only."""

from __future__ import annotations

from pyspark.sql import DataFrame

_ORDER = ("ID", "ELEMENT", "YEAR", "YEAR_MONTH", "COUNTRY_CODE", "CODE")


def in_report_order(df: DataFrame) -> DataFrame:
    """Sort by the key columns the table has: station, element, time, country.

    The operators return unsorted tables, so that a window or an aggregate taken from
    them does not pay for a sort it cannot use.
    """
    return df.orderBy(*(name for name in _ORDER if name in df.columns))
