"""Incremental-load job ledger, evaluated for every KPI at once.

Ledger rows: ``kpi, from_id, to_id, status, created_at, finished_at, retries, details``.
All decisions are grouped aggregates keyed by KPI (map-side partial
aggregation, so a KPI with a huge history does not become one hot task);
nothing loops over KPIs on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Job states and limits.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
STALE_DETAILS = "STALE JOB"
MAX_RETRIES = 2
BATCH_SIZE = 1000
MIN_IDS = 100
DEFAULT_STALE_AFTER = "15 minutes"

LEDGER_COLUMNS = ["kpi", "from_id", "to_id", "status", "created_at", "finished_at", "retries", "details"]


def _open_running() -> Column:
    return (F.col("status") == RUNNING) & F.col("finished_at").isNull()


def _age_state(as_of: str, stale_after: str) -> Column:
    """'running' while ``created_at + stale_after > as_of``, 'stale' when ``<``;
    exactly equal is neither (NULL)."""
    deadline = F.col("created_at") + F.expr(f"INTERVAL {stale_after}")
    now = F.to_timestamp(F.lit(as_of))
    return F.when(deadline > now, "running").when(deadline < now, "stale")


def running_jobs(ledger: DataFrame, as_of: str, stale_after: str = DEFAULT_STALE_AFTER) -> DataFrame:
    """Open RUNNING jobs classified as 'running' (young) or 'stale' (too old)."""
    return (ledger.filter(_open_running())
            .withColumn("state", _age_state(as_of, stale_after))
            .filter(F.col("state").isNotNull())
            .select("kpi", "from_id", "retries", "created_at", "state"))


def range_summary(ledger: DataFrame, as_of: str, stale_after: str = DEFAULT_STALE_AFTER) -> DataFrame:
    """One row per (kpi, from_id) with everything the decisions need, from one
    grouped aggregate (map-side combined, so a huge job history per KPI is
    reduced before the shuffle):

    ``n_jobs, has_running, stale_retries (smallest open stale attempt),
    max_to_id, failed_retries (highest finished FAILED), active_retries
    (highest open RUNNING or finished SUCCESS)``.
    """
    state = _age_state(as_of, stale_after)
    open_run = _open_running()
    done = F.col("finished_at").isNotNull()
    return ledger.groupBy("kpi", "from_id").agg(
        F.count("from_id").alias("n_jobs"),
        F.max(F.when(open_run & (state == "running"), F.lit(1))).alias("has_running"),
        F.min(F.when(open_run & (state == "stale"), F.col("retries"))).alias("stale_retries"),
        F.max("to_id").alias("max_to_id"),
        F.max(F.when((F.col("status") == FAILED) & done, F.col("retries"))).alias("failed_retries"),
        F.max(F.when(open_run | ((F.col("status") == SUCCESS) & done), F.col("retries"))).alias("active_retries"))


def _unsuperseded(summary: DataFrame) -> Column:
    """A range's highest finished FAILED attempt is superseded only when the
    highest open-RUNNING-or-SUCCESS attempt of that range is exactly one higher."""
    superseded = F.coalesce(F.col("failed_retries") == F.col("active_retries") - 1, F.lit(False))
    return F.col("failed_retries").isNotNull() & ~superseded


def failed_jobs(ledger: DataFrame) -> DataFrame:
    """Failed ranges with no newer attempt, per (kpi, from_id) (one aggregate, no self join)."""
    s = range_summary(ledger, "1970-01-01 00:00:00")
    return s.filter(_unsuperseded(s)).select("kpi", "from_id", F.col("failed_retries").alias("retries"))


def next_actions(registry: DataFrame, ledger: DataFrame, as_of: str, *,
                 stale_after: str = DEFAULT_STALE_AFTER, initial_from_id: int = 0,
                 max_retries: int = MAX_RETRIES) -> DataFrame:
    """Next step for every KPI of ``registry`` (column ``kpi``), strict priority:
    first run -> wait (a job is running) -> retry a stale job -> retry a failed
    range -> new range from ``max(to_id) + 1``.

    When several stale jobs or failed ranges exist, the one with the smallest
    ``(from_id, retries)`` is taken. Output ``(kpi, action, from_id, retries, mode)``;
    ``mode`` is 'bounded' once ``retries >= max_retries``. One scan of the
    ledger: a per-range summary, then a per-KPI aggregate of that summary.
    """
    s = range_summary(ledger, as_of, stale_after)
    per_kpi = s.groupBy("kpi").agg(
        F.sum("n_jobs").alias("n_jobs"),
        F.max("has_running").alias("has_running"),
        F.min(F.when(F.col("stale_retries").isNotNull(),
                     F.struct("from_id", F.col("stale_retries").alias("retries")))).alias("stale"),
        F.max("max_to_id").alias("max_to_id"),
        F.min(F.when(_unsuperseded(s), F.struct("from_id", F.col("failed_retries").alias("retries"))))
         .alias("failed"))
    j = registry.select("kpi").distinct().join(per_kpi, "kpi", "left")
    action = (F.when(F.coalesce(F.col("n_jobs"), F.lit(0)) == 0, "first_run")
              .when(F.col("has_running").isNotNull(), "wait")
              .when(F.col("stale").isNotNull(), "retry_stale")
              .when(F.col("failed").isNotNull(), "retry_failed")
              .otherwise("new"))
    j = j.withColumn("action", action)
    a = F.col("action")
    from_id = (F.when(a == "first_run", F.lit(initial_from_id).cast("bigint"))
               .when(a == "retry_stale", F.col("stale.from_id"))
               .when(a == "retry_failed", F.col("failed.from_id"))
               .when(a == "new", F.coalesce(F.col("max_to_id"), F.lit(0)) + 1))
    retries = (F.when(a.isin("first_run", "new"), F.lit(0))
               .when(a == "retry_stale", F.col("stale.retries") + 1)
               .when(a == "retry_failed", F.col("failed.retries") + 1))
    out = j.select("kpi", "action", from_id.cast("bigint").alias("from_id"), retries.cast("int").alias("retries"))
    mode = F.when(F.col("retries") >= max_retries, "bounded").when(F.col("retries").isNotNull(), "unbounded")
    return out.withColumn("mode", mode)


def apply_actions(ledger: DataFrame, actions: DataFrame, as_of: str) -> DataFrame:
    """Ledger after starting the chosen jobs.

    Stale jobs being retried are closed as FAILED ('STALE JOB', ``finished_at``
    = ``as_of``); every action except 'wait' appends a RUNNING row created at
    ``as_of``. One left join keyed by (kpi, from_id, retries) plus a union.
    """
    now = F.to_timestamp(F.lit(as_of))
    closing = (actions.filter(F.col("action") == "retry_stale")
               .select("kpi", "from_id", (F.col("retries") - 1).alias("retries"), F.lit(True).alias("__close")))
    j = ledger.join(closing, ["kpi", "from_id", "retries"], "left")
    close = F.coalesce(F.col("__close"), F.lit(False)) & _open_running()
    updated = j.select(
        "kpi", "from_id", "to_id",
        F.when(close, F.lit(FAILED)).otherwise(F.col("status")).alias("status"),
        "created_at",
        F.when(close, now).otherwise(F.col("finished_at")).alias("finished_at"),
        "retries",
        F.when(close, F.lit(STALE_DETAILS)).otherwise(F.col("details")).alias("details"))
    started = actions.filter(F.col("action") != "wait").select(
        "kpi", "from_id", F.lit(None).cast("bigint").alias("to_id"), F.lit(RUNNING).alias("status"),
        now.alias("created_at"), F.lit(None).cast("timestamp").alias("finished_at"),
        "retries", F.lit(None).cast("string").alias("details"))
    return updated.unionByName(started)


def close_jobs(ledger: DataFrame, outcomes: DataFrame, as_of: str) -> DataFrame:
    """Finish open jobs from ``outcomes`` ``(kpi, from_id, retries, success, to_id, details)``.

    SUCCESS or FAILED, ``finished_at = as_of``, ``to_id`` when given, details with
    single quotes stripped. Rows without an outcome are unchanged.
    """
    now = F.to_timestamp(F.lit(as_of))
    o = outcomes.select("kpi", "from_id", "retries", F.col("success").alias("__ok"),
                        F.col("to_id").alias("__to"), F.col("details").alias("__details"))
    j = ledger.join(o, ["kpi", "from_id", "retries"], "left")
    hit = F.col("__ok").isNotNull() & _open_running()
    return j.select(
        "kpi", "from_id",
        F.when(hit, F.coalesce(F.col("__to"), F.col("to_id"))).otherwise(F.col("to_id")).alias("to_id"),
        F.when(hit, F.when(F.col("__ok"), F.lit(SUCCESS)).otherwise(F.lit(FAILED)))
         .otherwise(F.col("status")).alias("status"),
        "created_at",
        F.when(hit, now).otherwise(F.col("finished_at")).alias("finished_at"),
        "retries",
        F.when(hit, F.regexp_replace(F.col("__details"), "'", "")).otherwise(F.col("details")).alias("details"))


def scan_ranges(records: DataFrame, jobs: DataFrame, *, key: str = "kpi", id_col: str = "id",
                batch_size: int = BATCH_SIZE) -> DataFrame:
    """Records of each job's id range: ``id >= from_id`` (unbounded) or
    ``from_id <= id <= from_id + batch_size`` (bounded).

    An equi-join on the KPI with the range as join condition: both sides shuffle
    by KPI (or the job list is broadcast when AQE sees it is small); a KPI with
    a third of all records is split by AQE's skew-join handling.
    """
    j = jobs.filter(F.col("from_id").isNotNull()).select(
        F.col("kpi").alias("__kpi"), F.col("from_id").alias("__from"), F.col("retries").alias("__retries"),
        F.col("mode").alias("__mode"))
    upper = F.when(F.col("__mode") == "bounded", F.col("__from") + batch_size)
    cond = ((F.col(key) == F.col("__kpi")) & (F.col(id_col) >= F.col("__from"))
            & (upper.isNull() | (F.col(id_col) <= upper)))
    return (records.join(j, cond, "inner")
            .withColumnsRenamed({"__from": "job_from_id", "__retries": "job_retries", "__mode": "job_mode"})
            .drop("__kpi"))


def validate_ranges(jobs: DataFrame, scanned: DataFrame, *, id_col: str = "id",
                    min_ids: int = MIN_IDS) -> DataFrame:
    """Outcome of each pulled range (one grouped aggregate + one left join):

    * no rows                        -> 'empty'    (FAILED)
    * ``max(id)`` 0 or below from_id -> 'invalid'  (FAILED, an error)
    * ``max(id) - from_id < min_ids``-> 'too_small' (FAILED, benign stop)
    * otherwise                      -> 'load'     (to_id = max(id))
    """
    s = scanned.groupBy(F.col("kpi").alias("__k"), F.col("job_from_id").alias("__f")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(id_col).alias("max_id"))
    j = jobs.filter(F.col("from_id").isNotNull()).join(
        s, (F.col("kpi") == F.col("__k")) & (F.col("from_id") == F.col("__f")), "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    outcome = (F.when(n == 0, "empty")
               .when((F.col("max_id") == 0) | (F.col("max_id") < F.col("from_id")), "invalid")
               .when(F.col("max_id") - F.col("from_id") < min_ids, "too_small")
               .otherwise("load"))
    return j.select("kpi", "from_id", "retries", "mode", n.alias("n_rows"), "max_id", outcome.alias("outcome"),
                    (outcome == "load").alias("success"),
                    F.when(outcome == "load", F.col("max_id")).alias("to_id"))


def preview(df: DataFrame, by: list[str], n: int = 50) -> DataFrame:
    """The first ``n`` records in the order of ``by``, for logging: a top-n, merged from each task's own."""
    return df.orderBy(*by).limit(n)


def id_range(records: DataFrame, id_col: str, from_id: int, mode: str = "unbounded", *,
             batch_size: int = BATCH_SIZE, to_id: int | None = None) -> DataFrame:
    """One manual id-range pull: ``id >= from_id`` (unbounded), ``from_id..to_id`` or
    ``from_id..from_id + batch_size`` (bounded). ``to_id <= from_id`` is an error."""
    c = F.col(id_col)
    if mode == "unbounded":
        return records.filter(c >= from_id)
    if mode != "bounded":
        raise ValueError(f"unknown mode {mode!r}")
    if to_id is not None:
        if to_id <= from_id:
            raise ValueError(f"to_id ({to_id}) must be greater than from_id ({from_id})")
        return records.filter(c.between(from_id, to_id))
    return records.filter(c.between(from_id, from_id + batch_size))
