"""Edge rows every operator must handle (NULLs, boundaries, bad text, re-runs)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ferrum.functions import dates as D
from ferrum.functions import text as X
from ferrum.operators import consent, retention
from ferrum.operators.joins import not_in
from ferrum.operators.signals import normalize_signals
from ferrum.sinks import writers as W
from ferrum.sources.days import day_pull_status, wanted_days
from ferrum.sources.files import select_input_files
from ferrum.sources.routing import resolve_routes, route_table


def test_unparseable_timestamp_and_number_become_null(spark):
    raw = spark.createDataFrame(
        [("v1", "2024-01-02T03:04:05+01:00", "speed", 1.5), ("v2", "garbage", "speed", 2.0)],
        "vin string, eventDate string, signalName string, signalValue double")
    rows = {r.vin: r for r in normalize_signals(raw, "2024-02-01 00:00:00").collect()}
    assert rows["v1"].observed_unix == int(dt.datetime(2024, 1, 2, 2, 4, 5, tzinfo=dt.timezone.utc).timestamp())
    assert rows["v1"].observed_day == 2
    assert rows["v2"].observed_unix is None and rows["v2"].observed_year is None
    df = spark.createDataFrame([("12.5",), ("n/a",), (None,)], "d string")
    assert [r[0] for r in df.select(F.col("d").try_cast("double")).collect()] == [12.5, None, None]


def test_null_join_key_never_matches(spark):
    contracts = spark.createDataFrame(
        [(None, "a", "p", "2024-01-01", "2025-01-01", "1"), ("V1", "b", "p", "x", "y", "2")],
        "vehicleIdentificationNumber string, subscriptionVehicleCategory string, product string, "
        "inceptionDate string, contractEndDate string, duration string")
    cons = spark.createDataFrame([(None,), ("V1",), ("V1",)], "vehicle_vin string")
    out = consent.filter_by_consent(contracts, cons).collect()
    assert [r.vehicleIdentificationNumber for r in out] == ["V1", "V1"]  # bag semantics, NULL unmatched


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert sorted(r.k for r in not_in(left, spark.createDataFrame([("a",)], "k string"), "k").collect()) == ["b"]
    assert not_in(left, spark.createDataFrame([("a",), (None,)], "k string"), "k").count() == 0
    empty = spark.createDataFrame([], "k string")
    assert not_in(left, empty, "k").count() == 3  # empty set keeps NULL keys too


def test_day_age_counts_date_boundaries(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:00",)], "ts string").select(F.col("ts").cast("timestamp"))
    age = df.select(D.day_age(F.col("ts"), F.to_timestamp(F.lit("2024-01-02 00:01:00")))).first()[0]
    assert age == 1


def test_retention_limit_and_null_age(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, None)], "id int, ts string"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    kept = retention.retention_delete(df, "ts", "2024-01-11 12:00:00", 10)
    assert sorted(r.id for r in kept.collect()) == [2, 3]  # exactly 10 days old -> removed; NULL kept
    erased = retention.erase_columns(df.withColumn("email", F.lit("x@y")), "ts", "2024-01-11 12:00:00",
                                     {10: "email, unknown_col"})
    got = {r.id: r.email for r in erased.collect()}
    assert got == {1: None, 2: "x@y", 3: "x@y"}


def test_job_exactly_at_limit_is_neither_running_nor_stale(spark):
    from ferrum.operators.ledger import running_jobs
    ledger = spark.createDataFrame(
        [("k", 1, None, "RUNNING", "2024-01-01 11:45:00", None, 0, None),
         ("k", 2, None, "RUNNING", "2024-01-01 11:50:00", None, 0, None),
         ("k", 3, None, "RUNNING", "2024-01-01 11:40:00", None, 0, None)],
        "kpi string, from_id long, to_id long, status string, created_at string, finished_at string, "
        "retries int, details string"
    ).withColumns({"created_at": F.col("created_at").cast("timestamp"),
                   "finished_at": F.col("finished_at").cast("timestamp")})
    got = {r.from_id: r.state for r in running_jobs(ledger, "2024-01-01 12:00:00").collect()}
    assert got == {2: "running", 3: "stale"}


def test_id_range_bounds(spark):
    from ferrum.operators.ledger import id_range
    df = spark.range(0, 3000).withColumnRenamed("id", "rid")
    assert id_range(df, "rid", 100).count() == 2900
    assert id_range(df, "rid", 100, "bounded").count() == 1001
    assert id_range(df, "rid", 100, "bounded", to_id=199).count() == 100
    with pytest.raises(ValueError):
        id_range(df, "rid", 100, "bounded", to_id=100)


def test_reversed_date_ranges(spark):
    row = spark.range(1).select(
        F.size(D.inclusive_days(F.lit("2024-01-05"), F.lit("2024-01-01"), "swap")).alias("swap"),
        F.size(D.inclusive_days(F.lit("2024-01-05"), F.lit("2024-01-01"), "empty")).alias("empty"),
        F.size(D.inclusive_days(F.lit("2024-01-01"), F.lit("2024-01-05"), "empty")).alias("fwd"),
        F.size(D.trailing_days(F.lit("2024-01-10"), 1)).alias("min_one"),
    ).first()
    assert (row.swap, row.empty, row.fwd, row.min_one) == (5, 0, 5, 1)
    days = [str(r.day) for r in wanted_days(spark, days=4, as_of="2024-01-10").collect()]
    assert days == ["2024-01-07", "2024-01-08", "2024-01-09"]
    with pytest.raises(ValueError):
        wanted_days(spark)


def test_file_selection_anchors_name_and_skips_empty(spark, tmp_dir):
    drop = os.path.join(tmp_dir, "drop")
    os.makedirs(os.path.join(drop, "sub"))
    with open(os.path.join(drop, "20240130_contracts.csv"), "w") as f:
        f.write("a,b\n1,2\n3,4\n")
    with open(os.path.join(drop, "20240130_contracts.csv.bak"), "w") as f:
        f.write("a,b\n9,9\n")
    with open(os.path.join(drop, "20240129_contracts.csv"), "w") as f:
        f.write("a,b\n5,6\n")
    open(os.path.join(drop, "20240130_empty.csv"), "w").close()
    got = select_input_files(spark, drop, "2024-01-30")
    assert sorted((r.a, r.filename) for r in got.collect()) == [("1", "20240130_contracts"),
                                                               ("3", "20240130_contracts")]


def test_day_with_empty_client_list_is_skipped(spark):
    wanted = wanted_days(spark, "2024-01-01", "2024-01-03")
    docs = spark.createDataFrame([("2024-01-01", 3), ("2024-01-02", 0)], "day string, n_clients int") \
        .withColumn("day", F.to_date("day"))
    got = {str(r.day): r.status for r in day_pull_status(wanted, docs).collect()}
    assert got == {"2024-01-01": "loaded", "2024-01-02": "empty", "2024-01-03": "error"}


def test_unrouted_keys(spark):
    keys = spark.createDataFrame([("meters/hourly/x.csv",), ("meters/nope/x.csv",), ("zzz/x.csv",),
                                  ("feeds/my_table/x.csv",), ("reviews/x.csv",)], "key string")
    got = {r.key: (r.status, r.target_table) for r in resolve_routes(keys, route_table(spark)).collect()}
    assert got["meters/hourly/x.csv"] == ("routed", "meter_hourly")
    assert got["meters/nope/x.csv"][0] == "unrouted"
    assert got["zzz/x.csv"][0] == "unrouted"
    assert got["feeds/my_table/x.csv"] == ("routed", "my_table")
    assert got["reviews/x.csv"] == ("routed", "reviews")


def test_range_rerun_has_no_duplicates(spark):
    cur = spark.createDataFrame([(i, "old") for i in range(10)], "id long, v string")
    new = spark.createDataFrame([(i, "new") for i in range(3, 6)], "id long, v string")
    once = W.replace_range(cur, new, "id", 3, 5)
    twice = W.replace_range(once, new, "id", 3, 5)
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())
    assert twice.count() == 10


def test_merge_non_null(spark):
    cur = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, x double")
    upd = spark.createDataFrame([(1, None, 5.0), (3, "c", None)], "k int, name string, x double")
    got = sorted(tuple(r) for r in W.merge_non_null(cur, upd, "k").collect())
    assert got == [(1, "a", 5.0), (2, "b", 2.0), (3, "c", None)]


def test_snake_case_and_url_decode(spark):
    df = spark.createDataFrame([("vehicleIdentificationNumber",), ("HTTPResponseCode",), ("a%2Fb+c",)], "s string")
    got = [tuple(r) for r in df.select(X.snake_case("s"), X.url_decode_plus("s")).collect()]
    assert got[0][0] == "vehicle_identification_number"
    assert got[1][0] == "http_response_code"
    assert got[2][1] == "a/b c"
    assert X.snake_case_name("subscriptionVehicleCategory") == "subscription_vehicle_category"


def test_versioned_commit_keeps_reader_consistent(spark, tmp_dir):
    name = "t_versions"
    W.commit_version(spark, name, spark.range(5).withColumnRenamed("id", "x"), tmp_dir)
    cur = spark.table(name)
    W.commit_version(spark, name, cur.filter("x >= 2"), tmp_dir)
    assert sorted(r.x for r in spark.table(name).collect()) == [2, 3, 4]
    spark.sql(f"DROP TABLE {name}")


def test_insert_values_and_duplicate_keys(spark, tmp_dir):
    from ferrum.sinks.tables import create_users_table, duplicate_keys, insert_values
    create_users_table(spark, "users_t", os.path.join(tmp_dir, "users"))
    insert_values(spark, "users_t", [(1, "Ann", "ann@example.com", "+1"), (1, "Bob", None, None)])
    d = duplicate_keys(spark.table("users_t"), ["id"]).collect()
    assert [(r.id, r.n) for r in d] == [(1, 2)]
    spark.sql("DROP TABLE users_t")


def test_day_documents_with_client_arrays(spark):
    wanted = wanted_days(spark, "2024-01-01", "2024-01-03")
    docs = spark.createDataFrame([("2024-01-01", ["a", "b"]), ("2024-01-02", [])],
                                 "day string, clients array<string>").withColumn("day", F.to_date("day"))
    got = {str(r.day): (r.status, r.n_clients) for r in day_pull_status(wanted, docs).collect()}
    assert got == {"2024-01-01": ("loaded", 2), "2024-01-02": ("empty", 0), "2024-01-03": ("error", None)}


def test_per_source_file_output_replaces_redelivered_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "processed")
    first = spark.createDataFrame([("a", "x/20240101_c.csv"), ("b", "x/20240102_c.csv")], "v string, filename string")
    W.write_per_source_file(first, path, mode="overwrite")
    again = spark.createDataFrame([("a2", "x/20240101_c.csv")], "v string, filename string")
    W.write_per_source_file(again, path, mode="overwrite")
    got = sorted((r.filename, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("20240101_c", "a2"), ("20240102_c", "b")]


def test_consent_vehicles_three_sources_bag_semantics(spark):
    um = spark.createDataFrame(
        [("V1", 1, "PRIMARY", "x,app-1,y"), ("V2", 2, "PRIMARY", "app-1"), ("V3", 3, "SECONDARY", "app-1"),
         ("V4", 4, "PRIMARY", "other"), ("V5", 5, "PRIMARY", "app-1")],
        "vehicle_vin string, aopuser_ssoid long, permission_userrole string, client_id_array string")
    docs = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (4, 1), (5, 1)], "cust_id long, is_latest int")
    cust = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 0), (5, 1)], "cust_id long, is_deleted_flag int")
    got = sorted(r.vehicle_vin for r in consent.consent_vehicles(um, docs, cust, client_id="app-1").collect())
    assert got == ["V1", "V1"]  # two latest documents -> two rows; V2 not latest, V3 role, V4 client, V5 deleted


def test_bucketed_table_join_shuffles_only_the_other_side(spark, tmp_dir):
    import contextlib
    import io
    name = "bucketed_contracts_t"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(2000).select(F.col("id").cast("string").alias("vin"), F.col("id").alias("v"))
    W.append_to_table(rows, name, os.path.join(tmp_dir, "bt"), bucket_by=(n, ["vin"]))
    W.append_to_table(rows, name)  # append keeps the bucketing
    other = spark.range(500).select(F.col("id").cast("string").alias("vin"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(name).join(other, "vin", "left_semi")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert buf.getvalue().count("Exchange hashpartitioning") == 1
        assert j.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE {name}")


def test_merge_non_null_reduces_updates_and_adds_columns(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    upd = spark.createDataFrame([(1, "x", 5, 1), (1, None, 7, 2), (3, "c", None, 1), (None, "n", 1, 1), (None, "m", 2, 1)],
                                "k int, name string, extra int, seq int")
    got = sorted((tuple(r) for r in W.merge_non_null(cur, upd, "k", order_by="seq").collect()), key=str)
    assert got == sorted([(1, "x", 7), (2, "b", None), (3, "c", None), (None, "n", 1), (None, "m", 2)], key=str)


def test_retention_keeps_layouts_and_leaves_no_deleted_row_on_disk(spark, tmp_dir):
    from ferrum.operators.retention import apply_retention_to_database
    db = "ret_layouts"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{os.path.join(tmp_dir, 'db')}'")
    rows = spark.createDataFrame([(1, "2020-01-01", "2024-02-28", "x", "p"), (2, "2024-02-20", "2020-01-01", "y", "p"),
                                  (3, "2024-02-20", "2024-02-28", "z", "q"), (4, "2019-01-01", "2019-01-01", "w", "o'r"),
                                  (5, None, None, "v", None)],
                                 "id int, made string, seen string, email string, part string").withColumns(
        {"made": F.col("made").cast("timestamp"), "seen": F.col("seen").cast("timestamp")})
    loc = {n: os.path.join(tmp_dir, n) for n in ("plain", "parted", "bucketed")}
    rows.write.option("path", loc["plain"]).saveAsTable(f"{db}.plain")
    rows.write.partitionBy("part").option("path", loc["parted"]).saveAsTable(f"{db}.parted")
    rows.write.bucketBy(3, "id").sortBy("id").option("path", loc["bucketed"]).saveAsTable(f"{db}.bucketed")
    spark.sql(f"CREATE VIEW {db}.v AS SELECT * FROM {db}.plain")
    untouched = {r[0] for r in spark.table(f"{db}.parted").filter("part = 'q'").select("_metadata.file_path").collect()}
    report = {r.table_name: tuple(r)[1:] for r in apply_retention_to_database(
        spark, db, "made", "2024-03-01 00:00:00", 700, {700: "email"}, os.path.join(tmp_dir, "versions"), erase_ts_col="seen").collect()}
    assert report == {"plain": (5, 2, 3, "ok"), "parted": (5, 2, 3, "ok"), "bucketed": (5, 2, 3, "ok"), "v": (None, None, None, "skipped: view")}
    for name in loc:
        assert sorted((r.id, r.email) for r in spark.table(f"{db}.{name}").collect()) == [(2, None), (3, "z"), (5, "v")]
        for folder in (loc[name], os.path.join(tmp_dir, "versions", db, name)):
            files = [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")]
            on_disk = spark.read.parquet(*files).select("id", "email").collect() if files else []
            assert not {1, 4} & {r.id for r in on_disk} and "y" not in {r.email for r in on_disk}
    assert spark.table(f"{db}.bucketed").groupBy("id").count().count() == 3  # read as bucketed
    assert {r[0] for r in spark.table(f"{db}.parted").filter("part = 'q'").select("_metadata.file_path").collect()} == untouched
    assert spark.sql(f"SHOW PARTITIONS {db}.parted").count() == 3  # the emptied one is gone
    again = apply_retention_to_database(spark, db, "made", "2024-03-01 00:00:00", 700, {700: "email"}, os.path.join(tmp_dir, "v2"), erase_ts_col="seen")
    assert {r.rows_removed for r in again.collect() if r.status == "ok"} == {0}
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_overwrite_all_keeps_the_old_table_when_the_write_fails(spark, tmp_dir):
    W.overwrite_all(spark, "full_t", spark.range(3), tmp_dir)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        W.overwrite_all(spark, "full_t", bad, tmp_dir)
    assert spark.table("full_t").count() == 3
    spark.sql("DROP TABLE full_t")


def test_csv_columns_meet_by_name(spark, tmp_dir):
    for name, text in (("20240130_a.csv", "x,y\n1,2\n"), ("20240130_b.csv", "y,x\n4,3\n"), ("20200101_old.csv", "zzz,yyy\n8,9\n")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    got = select_input_files(spark, tmp_dir, "2024-01-30")
    assert sorted(got.columns) == ["filename", "x", "y"]
    assert sorted((r.x, r.y, r.filename) for r in got.collect()) == [("1", "2", "20240130_a"), ("3", "4", "20240130_b")]
    assert select_input_files(spark, tmp_dir, "2023-01-01").count() == 0


def test_message_days(spark):
    from ferrum.functions.dates import parse_day
    df = spark.createDataFrame([("2023-05-01T08:15:00Z",), ("2023-05-01T23:15:00-05:00",), ("2023-05-01",), ("01.05.2023",), (None,)], "s string")
    assert [str(r[0]) for r in df.select(parse_day("s")).collect()] == ["2023-05-01", "2023-05-02", "2023-05-01", "None", "None"]
