"""Ledger decisions on hand-made job histories, and the KPI fact table."""

from pyspark.sql import functions as F

from ferrum.operators import ledger as L
from ferrum.operators.consent import file_kpis
from ferrum.operators.kpi import FILE_METRIC_NAMES, kpi_table, window_alarm

AS_OF = "2024-01-01 12:00:00"
SCHEMA = ("kpi string, from_id long, to_id long, status string, created_at string, finished_at string, "
          "retries int, details string")


def _ledger(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({
        "created_at": F.col("created_at").cast("timestamp"), "finished_at": F.col("finished_at").cast("timestamp")})


def _actions(spark, rows, registry):
    reg = spark.createDataFrame([(k,) for k in registry], "kpi string")
    return {r.kpi: (r.action, r.from_id, r.retries, r.mode)
            for r in L.next_actions(reg, _ledger(spark, rows), AS_OF, initial_from_id=7).collect()}


def test_priority_of_actions(spark):
    rows = [
        # wait: one young running job (and a stale one, which must not win)
        ("wait", 1, None, "RUNNING", "2024-01-01 11:55:00", None, 0, None),
        ("wait", 2, None, "RUNNING", "2024-01-01 10:00:00", None, 0, None),
        # stale beats failed; smallest (from_id, retries) is taken
        ("stale", 50, None, "RUNNING", "2024-01-01 09:00:00", None, 1, None),
        ("stale", 40, None, "RUNNING", "2024-01-01 09:00:00", None, 2, None),
        ("stale", 10, None, "FAILED", "2024-01-01 08:00:00", "2024-01-01 08:01:00", 0, None),
        # failed, not superseded -> retry with retries + 1, bounded at 2
        ("failed", 10, None, "FAILED", "2024-01-01 08:00:00", "2024-01-01 08:01:00", 1, None),
        # new: everything succeeded
        ("new", 1, 99, "SUCCESS", "2024-01-01 08:00:00", "2024-01-01 08:01:00", 0, None),
        ("new", 100, 250, "SUCCESS", "2024-01-01 09:00:00", "2024-01-01 09:01:00", 0, None),
    ]
    got = _actions(spark, rows, ["wait", "stale", "failed", "new", "first"])
    assert got["first"] == ("first_run", 7, 0, "unbounded")
    assert got["wait"][0] == "wait" and got["wait"][1] is None
    assert got["stale"] == ("retry_stale", 40, 3, "bounded")
    assert got["failed"] == ("retry_failed", 10, 2, "bounded")
    assert got["new"] == ("new", 251, 0, "unbounded")


def test_failed_superseded_only_by_next_attempt(spark):
    rows = [
        ("a", 10, None, "FAILED", "2024-01-01 08:00:00", "2024-01-01 08:01:00", 0, None),
        ("a", 10, 20, "SUCCESS", "2024-01-01 08:10:00", "2024-01-01 08:11:00", 1, None),  # supersedes
        ("b", 10, None, "FAILED", "2024-01-01 08:00:00", "2024-01-01 08:01:00", 0, None),
        ("b", 10, 20, "SUCCESS", "2024-01-01 08:10:00", "2024-01-01 08:11:00", 2, None),  # not exactly +1
        ("c", 10, None, "FAILED", "2024-01-01 08:00:00", None, 0, None),  # not finished: ignored
    ]
    got = sorted((r.kpi, r.from_id, r.retries) for r in L.failed_jobs(_ledger(spark, rows)).collect())
    assert got == [("b", 10, 0)]


def test_apply_and_close(spark):
    rows = [("s", 40, None, "RUNNING", "2024-01-01 09:00:00", None, 2, None)]
    led = _ledger(spark, rows)
    reg = spark.createDataFrame([("s",)], "kpi string")
    acts = L.next_actions(reg, led, AS_OF)
    new = L.apply_actions(led, acts, AS_OF)
    got = sorted((r.status, r.retries, r.details) for r in new.collect())
    assert got == [("FAILED", 2, "STALE JOB"), ("RUNNING", 3, None)]
    outcome = spark.createDataFrame([("s", 40, 3, True, 90, "it's done")],
                                    "kpi string, from_id long, retries int, success boolean, to_id long, details string")
    closed = {r.retries: r for r in L.close_jobs(new, outcome, AS_OF).collect()}
    assert closed[3].status == "SUCCESS" and closed[3].to_id == 90 and closed[3].details == "its done"
    assert closed[2].status == "FAILED"


def test_validate_ranges(spark):
    jobs = spark.createDataFrame([("a", 100, 0, "unbounded"), ("b", 100, 0, "unbounded"), ("c", 100, 0, "unbounded")],
                                 "kpi string, from_id long, retries int, mode string")
    recs = spark.createDataFrame([("a", i) for i in range(100, 400)] + [("b", i) for i in range(100, 150)],
                                 "kpi string, id long")
    got = {r.kpi: (r.outcome, r.to_id) for r in L.validate_ranges(jobs, L.scan_ranges(recs, jobs)).collect()}
    assert got == {"a": ("load", 399), "b": ("too_small", None), "c": ("empty", None)}


def test_file_kpis_and_long_table(spark):
    contracts = spark.createDataFrame(
        [("f1", "V1"), ("f1", "V1"), ("f1", "V2"), ("f2", "V3"), ("f2", None)],
        "filename string, vehicleIdentificationNumber string")
    cons = spark.createDataFrame([("V1",), ("V1",), ("V3",), ("V9",)], "vehicle_vin string")
    k = {r.filename: r for r in file_kpis(contracts, cons).collect()}
    assert (k["f1"].n_contracts, k["f1"].n_unique_vins, k["f1"].n_vins_with_consent,
            k["f1"].n_vins_without_consent, k["f1"].n_consent_total) == (3, 2, 1, 1, 3)
    assert (k["f2"].n_contracts, k["f2"].n_unique_vins, k["f2"].n_vins_with_consent) == (2, 1, 1)
    long = kpi_table(file_kpis(contracts, cons), FILE_METRIC_NAMES, as_of=AS_OF, context_col="filename")
    assert long.count() == 10
    assert long.schema["kpi_value"].dataType.simpleString() == "decimal(18,4)"
    assert long.columns == ["kpi_name", "kpi_value", "unit", "kpi_timestamp", "category", "sub_category",
                            "context", "version", "environment"]


def test_window_alarm_threshold(spark):
    df = spark.createDataFrame([("2024-01-01 00:01:00", 0.0), ("2024-01-01 00:14:00", 3.0),
                                ("2024-01-01 00:16:00", 1.0)], "ts string, v double").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    got = [(str(r.window_start), r.stat, r.state) for r in window_alarm(df, "ts", "v").orderBy("window_start").collect()]
    assert got == [("2024-01-01 00:00:00", 0.0, "ALARM"), ("2024-01-01 00:15:00", 1.0, "OK")]
