"""KPI facts: wide metric rows -> the long KPI table, and threshold alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrum.functions.dates import to_decimal4

# The columns of the fact table.
KPI_COLUMNS = [
    "kpi_name", "kpi_value", "unit", "kpi_timestamp", "category", "sub_category",
    "context", "version", "environment",
]

# Names of the file metrics of ``file_kpis`` in the fact table (overridable).
FILE_METRIC_NAMES = {
    "n_contracts": "file_rows",
    "n_unique_vins": "file_vehicles",
    "n_vins_with_consent": "file_vehicles_consenting",
    "n_vins_without_consent": "file_vehicles_refused",
    "n_consent_total": "consenting_vehicles",
}

# Names of the metrics over the stored contract table.
STORED_METRIC_NAMES = {
    "n_refused": "stored_rows_without_consent",
    "n_new": "vehicles_first_seen",
    "n_known": "vehicles_seen_before",
}


def kpi_table(wide: DataFrame, metrics: dict[str, str], *, as_of: str, context_col: str | None = None,
              context: str = "n/a", unit: str = "Count", category: str = "Interface",
              sub_category: str = "Pipeline", version: str = "1", environment: str = "dev") -> DataFrame:
    """Unpivot metric columns of ``wide`` into the 9-column KPI fact table.

    One output row per (input row, metric). Values are ``decimal(18,4)``; a NULL
    metric stays NULL. ``context`` is ``context_col``'s value per row, or a literal.
    """
    names = list(metrics)
    stacked = F.stack(F.lit(len(names)), *[x for c in names for x in (F.lit(metrics[c]), F.col(c).cast("double"))])
    ctx = F.col(context_col) if context_col else F.lit(context)
    long = wide.select(ctx.alias("context"), stacked.alias("kpi_name", "kpi_value_raw"))
    return long.select(
        "kpi_name",
        to_decimal4(F.col("kpi_value_raw")).alias("kpi_value"),
        F.lit(unit).alias("unit"),
        F.to_timestamp(F.lit(as_of)).alias("kpi_timestamp"),
        F.lit(category).alias("category"),
        F.lit(sub_category).alias("sub_category"),
        F.col("context").cast("string").alias("context"),
        F.lit(version).alias("version"),
        F.lit(environment).alias("environment"),
    )


def merge_metric_sets(*tables: DataFrame) -> DataFrame:
    """Union of KPI tables (metric names of the sets are disjoint)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def window_alarm(df: DataFrame, ts: str, value: str, *, period_seconds: int = 900,
                 threshold: float = 0.0, statistic: str = "min", keys: list[str] | None = None,
                 comparison: str = "<=") -> DataFrame:
    """Tumbling-window metric alarm: ``statistic(value)`` per period (and keys)
    compared with ``threshold``; periods without data produce no row (not breaching).
    """
    agg = {"min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg}[statistic]
    cmp = {"<=": lambda c: c <= threshold, ">=": lambda c: c >= threshold,
           "<": lambda c: c < threshold, ">": lambda c: c > threshold}[comparison]
    keys = keys or []
    w = F.window(F.col(ts), f"{period_seconds} seconds")
    out = df.groupBy(w.alias("window"), *keys).agg(agg(F.col(value)).alias("stat"))
    return out.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
        "stat", F.when(cmp(F.col("stat")), "ALARM").otherwise("OK").alias("state"))


def alarm_calendar(df: DataFrame, ts: str, value: str, *, keys: list[str], start: str, end: str, period_seconds: int = 900,
                   threshold: float = 0.0, statistic: str = "min", comparison: str = "<=") -> DataFrame:
    """``window_alarm`` for every period of every key from ``start`` to ``end`` (exclusive); a period without data is
    ``OK`` with a NULL ``stat``. The keys are those that occur in ``df``; one row per key and period, made by Spark
    from the key list, so a key with very many samples adds none."""
    found = window_alarm(df, ts, value, period_seconds=period_seconds, threshold=threshold, statistic=statistic, keys=keys, comparison=comparison)
    first, last = F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end)) - F.expr(f"INTERVAL {period_seconds} SECONDS")
    periods = df.select(*keys).distinct().withColumn(
        "window_start", F.explode(F.sequence(first, last, F.expr(f"INTERVAL {period_seconds} SECONDS"))))
    periods = periods.withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {period_seconds} SECONDS"))
    f = found.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("window_start").alias("__at"), "stat", "state")
    on = F.col("window_start") == F.col("__at")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return periods.join(f, on, "left").select("window_start", "window_end", *keys, "stat", F.coalesce("state", F.lit("OK")).alias("state"))


def alarm_transitions(calendar: DataFrame, keys: list[str], initial: str = "OK") -> DataFrame:
    """One row per change of a key's state, (window_start, keys, state_before, state): what to notify. The state
    before a key's first period is ``initial``."""
    before = F.lag("state", 1, initial).over(Window.partitionBy(*keys).orderBy("window_start"))
    return calendar.withColumn("state_before", before).filter(F.col("state") != F.col("state_before")).select(
        "window_start", *keys, "state_before", "state")
