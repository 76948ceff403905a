"""Vehicle signal normalisation (long/narrow time series)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.functions.dates import as_of_literal, epoch_seconds, parse_iso_offset

SIGNAL_OUTPUT_COLUMNS = [
    "vin", "observed_unix", "processed_unix", "observed_year", "observed_month",
    "observed_day", "signal_value", "signal_name",
]
SIGNAL_PARTITION_COLUMNS = ["signal_name", "observed_year", "observed_month"]


def normalize_signals(df: DataFrame, as_of: str, *, vin: str = "vin", event_date: str = "eventDate",
                      name: str = "signalName", value: str = "signalValue") -> DataFrame:
    """Raw ``(vin, eventDate, signalName, signalValue)`` -> typed, time-partitioned signal rows.

    ``eventDate`` is ISO-8601 text with an offset; an unparseable date gives NULL
    time parts (the row is kept). ``processed_unix`` is the explicit ``as_of``.
    Pure projection: stays inside one codegen stage, no shuffle.
    """
    ts = parse_iso_offset(F.col(event_date))
    return df.select(
        F.col(vin).alias("vin"),
        epoch_seconds(ts).alias("observed_unix"),
        epoch_seconds(as_of_literal(as_of)).alias("processed_unix"),
        F.year(ts).alias("observed_year"),
        F.month(ts).alias("observed_month"),
        F.dayofmonth(ts).alias("observed_day"),
        F.col(value).alias("signal_value"),
        F.col(name).alias("signal_name"),
    )
