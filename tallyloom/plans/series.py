"""Cleaning of time series, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.fixed import SERIES_COLUMNS
from tallyloom.functions.series import period_to_date
from tallyloom.operators import timeseries as T


def clean_series(raw: DataFrame, catalogue: DataFrame | None, codes=None) -> DataFrame:
    """Decoded, dated and converted series rows in their published columns.

    The published order is a matter of the sink: `write_cleaned(..., order=("series_id", "year", "period"))`
    sorts each file, and `series_order` sorts what is shown.
    """
    typed = T.typed(raw)
    if catalogue is None:
        shaped = T.blank_dimensions(typed)
    else:
        known = T.decode_dimensions(T.title_fallback(T.with_catalogue(typed, catalogue)))
        shaped = T.percent_to_thousands(known, T.denominators(typed, codes))
    dated = shaped.withColumn("date", period_to_date(F.col("year"), F.col("period")))
    return dated.select(*SERIES_COLUMNS)
