"""Decisions where the original behaviour is not copied, and format tolerance."""

import gzip
import os

from pyspark.sql import functions as F

from ferrum.operators.kpi import kpi_table
from ferrum.operators.rejects import error_lines
from ferrum.sinks.writers import replace_where
from ferrum.sources.routing import landed_keys, load_routes, route_table, unrouted


def test_null_metric_gives_null_kpi_value(spark):
    wide = spark.createDataFrame([("f1", 3, None)], "filename string, a long, b long")
    rows = {r.kpi_name: r.kpi_value for r in kpi_table(wide, {"a": "metric_a", "b": "metric_b"},
                                                        as_of="2024-01-01 00:00:00", context_col="filename").collect()}
    assert rows["metric_b"] is None
    assert str(rows["metric_a"]) == "3.0000"


def test_ordinal_is_the_number_between_slashes(spark):
    resp = spark.createDataFrame([(1, "Description: /12/ bad: a/b\nDescription: /3/ missing id\nno ordinal")],
                                 "batch int, error_text string")
    got = [(r.ordinal, r.error_message) for r in error_lines(resp, ["batch"]).collect()]
    assert sorted(got, key=str) == [(12, "bad: a/b"), (3, "missing id"), (None, "no ordinal")]


def test_pipe_delimited_gzip_with_undecodable_bytes(spark, tmp_dir):
    d = os.path.join(tmp_dir, "vendors", "2024", "01", "02")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "part.csv.gz"), "wb") as f:
        f.write(b"id|name\n1|ok\n2|bad\xff\xfename\n")
    loaded = dict((route["target_table"], df) for route, df in load_routes(spark, tmp_dir, route_table(spark)))
    rows = {r.id: r.name for r in loaded["vendor_list"].collect()}
    assert rows["1"] == "ok"
    assert rows["2"].startswith("bad") and rows["2"].endswith("name") and "�" in rows["2"]


def test_replace_where(spark):
    cur = spark.createDataFrame([("2024-01-01", "prod", 1), ("2024-01-01", "test", 2), ("2024-01-02", "prod", 3),
                                 (None, "prod", 4)], "date string, env string, v int")
    new = spark.createDataFrame([("2024-01-01", "prod", 10)], "date string, env string, v int")
    got = sorted(r.v for r in replace_where(cur, new, (F.col("date") == "2024-01-01") & (F.col("env") == "prod")).collect())
    assert got == [2, 3, 4, 10]


def test_failed_route_is_reported_and_others_load(spark, tmp_dir):
    from ferrum.sources.routing import load_into_tables
    land = os.path.join(tmp_dir, "land")
    for prefix, rows in [("meters/hourly/2024/01/02", [("1", "a")]), ("reviews", [("2", "b"), ("3", "c")]), ("lost/way", [("4", "d")])]:
        spark.createDataFrame(rows, "id string, v string").coalesce(1).write.option("header", True).csv(
            os.path.join(land, prefix))
    tables = os.path.join(tmp_dir, "tables")
    spark.sql(f"CREATE DATABASE routed_t LOCATION '{os.path.join(tmp_dir, 'db')}'")
    spark.range(1).write.saveAsTable("routed_t.meter_hourly")  # a table of other columns
    report = {r.target_table: (r.status, r.n_rows, r.error) for r in
              load_into_tables(spark, load_routes(spark, land, route_table(spark)), "routed_t", tables).collect()}
    assert report["meter_hourly"][0] == "failed" and len(report["meter_hourly"][2]) > 100  # the whole text
    assert report["reviews"] == ("loaded", 2, None)
    rest = {r.prefix: r.n_files for r in unrouted(landed_keys(spark, land), route_table(spark)).collect()}
    assert rest == {"lost/way": 1}
    spark.sql("DROP DATABASE routed_t CASCADE")


def test_union_aligned_ragged_batches(spark):
    from ferrum.operators.columns import union_aligned
    a = spark.createDataFrame([(1, "DE")], "id long, country string")
    b = spark.createDataFrame([(2, "ios", "x")], "id long, os string, extra string")
    out = union_aligned([a, b], ["id", "country", "os", "app_date"])
    assert out.columns == ["id", "country", "os", "app_date", "extra"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "DE", None, "", None), (2, None, "ios", "", "x")]


def test_key_segments(spark):
    from ferrum.functions.text import file_stem, key_segment
    df = spark.createDataFrame([("kpi/appstate/20240101_x.csv",), ("flat.csv",)], "k string")
    got = [tuple(r) for r in df.select(key_segment("k", 1), key_segment("k", 2), key_segment("k", -1),
                                       file_stem("k")).collect()]
    assert got == [("kpi", "appstate", "20240101_x.csv", "20240101_x"), ("flat.csv", None, "flat.csv", "flat")]
