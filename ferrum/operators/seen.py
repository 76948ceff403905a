"""Which vehicles are new on a day, from a maintained first-seen / last-seen table instead of the whole history.

The table has rows (vehicle, first_day, last_day). A day's run appends one row per vehicle of the day; what a
vehicle's rows say together is their smallest and largest day, so a repeated run changes nothing and days may
come in any order. ``compacted`` reduces the rows to one per vehicle. A day's question reads this table
for the day's vehicles, never the contracts of other days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEEN_SCHEMA = "vin string, first_day date, last_day date"


def sightings(day_rows: DataFrame, day: str, vin: str = "vehicle_identification_number") -> DataFrame:
    """The rows that a day adds: its distinct vehicles (a NULL vehicle too, as it decides ``NOT IN``)."""
    d = F.to_date(F.lit(day))
    return day_rows.select(F.col(vin).cast("string").alias("vin")).distinct().select("vin", d.alias("first_day"), d.alias("last_day"))


def compacted(seen: DataFrame) -> DataFrame:
    """One row per vehicle."""
    return seen.groupBy("vin").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def record_day(spark: SparkSession, table: str, day_rows: DataFrame, day: str, path: str, vin: str = "vehicle_identification_number") -> None:
    """Append a day's vehicles to the table (created at ``path`` on first use)."""
    from ferrum.sinks.writers import append_to_table
    append_to_table(sightings(day_rows, day, vin), table, path)


def compact_seen(spark: SparkSession, table: str, path: str) -> None:
    """Rewrite the table with one row per vehicle, as a new version: its size follows the vehicles, not the days."""
    from ferrum.sinks.writers import commit_version
    commit_version(spark, table, compacted(spark.table(table)), path)


def _of_the_day(seen: DataFrame, day_rows: DataFrame, day: str, vin: str) -> DataFrame:
    """The day's distinct vehicles with ``elsewhere``: whether the table has them on another day (NULL never matches)."""
    today = day_rows.select(F.col(vin).cast("string").alias("vin")).distinct()
    mine = compacted(seen.join(today.filter("vin IS NOT NULL"), "vin", "left_semi"))
    other = _other(day)
    return today.join(mine.filter(other).select("vin", F.lit(True).alias("elsewhere")), "vin", "left")


def _other(day: str):
    d = F.to_date(F.lit(day))
    return (F.col("first_day") < d) | (F.col("last_day") > d)


def newly_added_since(seen: DataFrame, day_rows: DataFrame, day: str, vin: str = "vehicle_identification_number") -> DataFrame:
    """Distinct vehicles of the day that no other day has: SQL ``NOT IN`` over the other days' vehicles, so a NULL
    vehicle on another day leaves none, and a NULL of the day counts only where there is no other day."""
    rest = seen.filter(_other(day))
    some = rest.limit(1).agg(F.count(F.lit(1))).scalar()
    nulls = rest.filter("vin IS NULL").limit(1).agg(F.count(F.lit(1))).scalar()
    found = _of_the_day(seen, day_rows, day, vin).filter("elsewhere IS NULL")
    return found.filter((some == 0) | ((nulls == 0) & F.col("vin").isNotNull())).select(F.col("vin").alias(vin))


def existing_since(seen: DataFrame, day_rows: DataFrame, day: str, vin: str = "vehicle_identification_number") -> DataFrame:
    """Distinct vehicles of the day that another day has too."""
    return _of_the_day(seen, day_rows, day, vin).filter("elsewhere").select(F.col("vin").alias(vin))
