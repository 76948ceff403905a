"""Freshness monitoring: tracked vehicles without messages or updates, missing files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.functions.dates import DOTTED_DAY_FORMAT, day_age, inclusive_days
from ferrum.operators.joins import is_in


def _of_country(vehicle: DataFrame, dealers: DataFrame, country: str) -> DataFrame:
    d = dealers.filter(F.col("dealership_country") == country)
    return is_in(vehicle, d, "commission_number")


def missing_messages(vehicle: DataFrame, dealers: DataFrame, country: str) -> DataFrame:
    """Distinct vehicles of ``country`` that never received a message (no order key)."""
    return _of_country(vehicle, dealers, country).filter(F.col("ifa_order_key").isNull()).distinct()


def stale_updates(vehicle: DataFrame, dealers: DataFrame, country: str, as_of: str,
                  max_age_days: int = 1) -> DataFrame:
    """Distinct vehicles of ``country`` whose last event is more than ``max_age_days`` days old."""
    age = day_age(F.col("event_timestamp"), F.to_timestamp(F.lit(as_of)))
    return _of_country(vehicle, dealers, country).filter(age > max_age_days).distinct()


def freshness_alerts(vehicle: DataFrame, dealers: DataFrame, as_of: str, stage: str = "dev",
                     max_age_days: int = 1) -> DataFrame:
    """Alert rows ``(subject, check, country, n_rows)`` for every country at once.

    Each check counts distinct vehicle rows of the country, as the per-country
    queries do; countries with nothing to report produce no row. Both checks
    come out of one join and one grouped aggregate.
    """
    v = vehicle.distinct()
    d = dealers.select("commission_number", "dealership_country").distinct()
    j = v.join(d, "commission_number")
    age = day_age(F.col("event_timestamp"), F.to_timestamp(F.lit(as_of)))
    counts = j.groupBy("dealership_country").agg(
        F.sum(F.col("ifa_order_key").isNull().cast("long")).alias("missing_messages"),
        F.sum(F.coalesce(age > max_age_days, F.lit(False)).cast("long")).alias("missing_updates"))
    long = counts.select(
        "dealership_country",
        F.stack(F.lit(2), F.lit("missing_messages"), "missing_messages",
                F.lit("missing_updates"), "missing_updates").alias("check", "n_rows"))
    subject = F.concat_ws(" - ", F.concat_ws("-", F.lit(stage.upper()), F.col("dealership_country")),
                          F.lit("vehicle monitoring"), F.regexp_replace("check", "_", " "))
    return long.filter(F.col("n_rows") > 0).select(
        subject.alias("subject"), "check", F.col("dealership_country").alias("country"), "n_rows")


def missing_days(landed: DataFrame, ts_col: str, from_day: str, to_day: str,
                 subject: str = "missing input file") -> DataFrame:
    """Expected days in ``[from_day, to_day]`` (reversed ends are swapped) that have
    no landed row, formatted ``dd.MM.yyyy``, one alert row each."""
    spark = landed.sparkSession
    expected = spark.range(1).select(
        F.explode(inclusive_days(F.lit(from_day), F.lit(to_day))).alias("day"))
    present = landed.select(F.to_date(F.col(ts_col)).alias("day")).distinct()
    gone = expected.join(present, "day", "left_anti")
    return gone.select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                       F.date_format("day", DOTTED_DAY_FORMAT).alias("day_text"),
                       F.concat(F.lit(subject + " for "), F.date_format("day", DOTTED_DAY_FORMAT)).alias("subject"))
