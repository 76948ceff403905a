"""Command-line jobs run in-process against the test session."""

import os

from ferrum import cli


def test_ingest_signals_cli(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    spark.createDataFrame(
        [("V1", "2024-01-02T03:04:05Z", "speed", 1.0), ("V2", "2024-02-02T03:04:05+01:00", "speed", 2.0),
         ("V3", "2024-01-05T00:00:00Z", "temp", 3.0)],
        "vin string, eventDate string, signalName string, signalValue double").write.json(raw)
    target = os.path.join(tmp_dir, "signals")
    assert cli.main(["ingest-signals", "--source", raw, "--target", target, "--table", "signals_cli_t",
                     "--as-of", "2024-03-01 00:00:00"]) == 0
    got = sorted((r.signal_name, r.observed_year, r.observed_month, r["count"])
                 for r in spark.table("signals_cli_t").groupBy("signal_name", "observed_year", "observed_month")
                 .count().collect())
    assert got == [("speed", 2024, 1, 1), ("speed", 2024, 2, 1), ("temp", 2024, 1, 1)]
    assert {r.processed_unix for r in spark.table("signals_cli_t").collect()} == {1709251200}
    spark.sql("DROP TABLE signals_cli_t")


def test_retention_cli(spark, tmp_dir, capsys):
    spark.sql(f"CREATE DATABASE ret_cli_db LOCATION '{os.path.join(tmp_dir, 'db')}'")
    data = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, "2020-01-01 00:00:00", "a@b"), (2, "2024-01-01 00:00:00", "c@d")],
                          "id int, ts string, email string").selectExpr(
        "id", "cast(ts as timestamp) as ts", "email").write.parquet(data)
    spark.catalog.createTable("ret_cli_db.t", path=data, source="parquet")
    assert cli.main(["retention", "--database", "ret_cli_db", "--ts-column", "ts", "--days", "700",
                     "--erase", "30=email", "--version-root", os.path.join(tmp_dir, "versions"), "--as-of", "2024-03-01 00:00:00"]) == 0
    assert '"rows_removed": 1' in capsys.readouterr().out
    rows = [tuple(r) for r in spark.table("ret_cli_db.t").collect()]
    assert len(rows) == 1 and rows[0][0] == 2 and rows[0][2] is None
    spark.sql("DROP DATABASE ret_cli_db CASCADE")
