"""Hot keys: one key holding a large share of the rows must be split, not funnelled."""

import os

from pyspark.sql import functions as F

from ferrum.operators.joins import in_ranges
from ferrum.plans.standins import checkpoint_messages
from ferrum.sinks.writers import partitioned_write


def test_rebalanced_write_splits_a_hot_partition_value(spark, tmp_dir):
    n = 400_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("signal_name"),  # hot: two thirds
        F.xxhash64("id").alias("value"))
    path = os.path.join(tmp_dir, "out")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        partitioned_write(df, path, ["signal_name"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    assert sum(r["count"] for r in rows) == n
    assert max(r["count"] for r in rows) < n / 5  # no task wrote a large share, though one value has two thirds


def test_an_order_of_many_items_is_one_message(spark):
    big = 10_000
    lineitem = spark.range(big + 3).select(
        F.when(F.col("id") < big, F.lit(1)).otherwise(F.lit(2)).cast("long").alias("l_orderkey"),
        F.col("id").cast("int").alias("l_linenumber"),
        F.col("id").alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"))
    orders = spark.createDataFrame([(1, 10, "2024-01-01 00:00:00"), (2, 20, "2024-01-01 00:00:00")],
                                   "o_orderkey long, o_custkey long, o_orderdate string").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    sizes = checkpoint_messages(orders, lineitem).select(
        F.get_json_object("body", "$.commissionNumber").alias("cn"),
        F.from_json(F.get_json_object("body", "$.message.elements"), "array<struct<checkpointNumber:bigint,timestamp:string>>").alias("e"))
    got = {r.cn: sorted(x.checkpointNumber for x in r.e) for r in sizes.collect()}
    assert got == {"1": list(range(big)), "2": [big, big + 1, big + 2]}


def test_range_join_on_hot_key_with_many_ranges(spark):
    records = spark.range(0, 20000).select(F.lit("hot").alias("kpi"), F.col("id"))
    ranges = spark.range(0, 200).select(F.lit("hot").alias("kpi"), (F.col("id") * 100).alias("from_id"),
                                        (F.col("id") * 100 + 9).alias("to_id"))
    inside = in_ranges(records, ranges, key="kpi", id_col="id")
    outside = in_ranges(records, ranges, key="kpi", id_col="id", how="left_anti")
    assert inside.count() == 2000 and outside.count() == 18000


def test_range_join_cost_does_not_follow_the_distance_of_ids(spark):
    records = spark.createDataFrame([("a", 5), ("a", 10**13 - 1), ("b", 7)], "kpi string, id long")
    ranges = spark.createDataFrame([("a", 0, 10**13)], "kpi string, from_id long, to_id long")
    assert in_ranges(records, ranges, key="kpi", id_col="id").count() == 2
