"""Commits: many partitions at once, blocks, two writers, loads by key, sweeps, records across splits, partitions of a write."""

import csv
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from ferrum.operators import seen as S
from ferrum.operators.joins import in_ranges
from ferrum.operators.retention import apply_retention_to_table
from ferrum.plans import jobs
from ferrum.sinks import blocks as B
from ferrum.sinks import writers as W
from ferrum.sinks.loads import drop_unfinished, load_keys, manifest, pending
from ferrum.sinks.versions import CommitConflict, VersionedTable, claim, exclusive
from ferrum.sources.files import read_csv_by_header, read_csv_records
from ferrum.sources.routing import route_table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


class Failing:
    """The session, with SQL statements that contain ``text`` failing from the ``nth`` on."""

    def __init__(self, spark, text, nth=1):
        self._spark, self._text, self._left = spark, text, nth

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def sql(self, statement):
        if self._text in statement:
            self._left -= 1
            if self._left <= 0:
                raise RuntimeError("killed")
        return self._spark.sql(statement)


def _table(spark, tmp_dir, name, n=40):
    df = spark.range(n).select("id", (F.col("id") % 8).alias("p"), F.when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("a/=%"), F.col("id") % 3)).alias("q"))
    W.commit_version(spark, name, df, tmp_dir, partition_cols=["p", "q"])
    return df


@pytest.mark.parametrize("text,nth", [("ADD PARTITION", 2), ("CREATE TABLE", 1), ("RENAME TO", 1)])
def test_a_commit_that_fails_between_partitions_leaves_the_old_table(spark, tmp_dir, monkeypatch, text, nth):
    name = f"half_{text[:3].lower()}"
    before = rows(_table(spark, tmp_dir, name).select("id", "p", "q"))
    monkeypatch.setattr(W, "PARTITIONS_PER_STATEMENT", 3)
    new = spark.table(name).withColumn("id", F.col("id") + 1000)
    with pytest.raises(RuntimeError):
        W.commit_version(Failing(spark, text, nth), name, new, tmp_dir)
    assert rows(spark.table(name)) == before
    W.commit_version(spark, name, new, tmp_dir)
    assert rows(spark.table(name)) == sorted(((i + 1000, p, q) for i, p, q in before), key=str)


def test_a_commit_that_fails_between_the_renames_is_finished(spark, tmp_dir):
    before = rows(_table(spark, tmp_dir, "between").select("id", "p", "q"))
    with pytest.raises(RuntimeError):
        W.commit_version(Failing(spark, "RENAME TO", 2), "between", spark.table("between").filter("id < 30"), tmp_dir)
    assert not spark.catalog.tableExists("between") and W.recover_switch(spark, "between")
    assert rows(spark.table("between")) == [r for r in before if r[0] < 30]
    assert not W.recover_switch(spark, "between") and not spark.catalog.tableExists("between__prev")


def test_only_touched_partitions_get_new_files(spark, tmp_dir):
    _table(spark, tmp_dir, "touched")
    before = W.table_partitions(spark, "touched", ["p", "q"])
    hit = [{"p": "3", "q": None}, {"p": "1", "q": "a/=%1"}]
    part = spark.table("touched").filter(W.partition_in(["p", "q"], hit))
    ids = rows(part.select("id"))
    assert ids and "PartitionFilters: [" in part._jdf.queryExecution().toString()
    W.commit_version(spark, "touched", part.filter("p = 3").withColumn("id", -F.col("id")), tmp_dir, touched=hit)
    after = W.table_partitions(spark, "touched", ["p", "q"])
    assert {k for k in before if before[k] != after.get(k)} == {("3", None), ("1", "a/=%1")} and ("1", "a/=%1") not in after
    assert spark.table("touched").count() == 40 - sum(1 for (i,) in ids if i % 8 == 1)


def test_a_managed_partitioned_table_is_rewritten_whole_once(spark, tmp_dir):
    spark.sql("CREATE TABLE managed_p (id LONG, p LONG) USING parquet PARTITIONED BY (p)")
    spark.range(20).select("id", (F.col("id") % 4).alias("p")).write.insertInto("managed_p")
    W.commit_version(spark, "managed_p", spark.table("managed_p").filter("p = 1 AND id < 6"), tmp_dir, touched=[{"p": "1"}])
    assert rows(spark.table("managed_p").select("id")) == sorted([(i,) for i in range(20) if i % 4 != 1 or i < 6], key=str)
    assert not W.table_layout(spark, "managed_p").managed


def test_retention_without_a_hit_keeps_every_file(spark, tmp_dir):
    df = spark.range(10).select("id", F.lit("2024-02-01 00:00:00").cast("timestamp").alias("made"), F.lit("x").alias("email"))
    for name, by in (("ret_plain", None), ("ret_parts", ["id"])):
        W.commit_version(spark, name, df, os.path.join(tmp_dir, name), partition_cols=by)
        files = sorted(spark.table(name).inputFiles())
        args = (spark, name, "2024-03-01 00:00:00")
        assert apply_retention_to_table(*args, 700, {700: "email"}, tmp_dir, delete_ts_col="made") == (10, 0)
        assert sorted(spark.table(name).inputFiles()) == files
        assert apply_retention_to_table(*args, 700, {7: "email"}, tmp_dir, delete_ts_col="made") == (10, 0)
        assert spark.table(name).filter("email IS NOT NULL").count() == 0
        files = sorted(spark.table(name).inputFiles())
        assert apply_retention_to_table(*args, 700, {7: "email"}, tmp_dir, delete_ts_col="made") == (10, 0)
        assert sorted(spark.table(name).inputFiles()) == files  # erased already


def test_range_replace_rewrites_the_blocks_of_its_ranges_only(spark, tmp_dir):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("kpi"), "id", F.lit("old").alias("v"))
    df = df.unionByName(spark.createDataFrame([("0", None, "old"), (None, 5, "old")], "kpi string, id long, v string"))
    B.create_blocked_table(spark, "blocked", df, tmp_dir, key="kpi", id_col="id", block_size=100)
    before = W.table_partitions(spark, "blocked", ["kpi", "id_block"])
    ranges = spark.createDataFrame([("0", 150, 420), ("1", 990, 1000), ("9", 0, 10 ** 9), ("2", None, 5)], "kpi string, from_id long, to_id long")
    new = spark.createDataFrame([("0", 153, "new"), ("1", 997, "new"), ("7", 77, "new"), ("2", 2999, "extra")], "kpi string, id long, v string")
    for _ in range(2):
        expect = W.replace_keyed_ranges(spark.table("blocked").drop("id_block"), new, ranges, key="kpi", id_col="id")
        want = set(rows(expect))
        hit = B.replace_ranges_in_blocks(spark, "blocked", new, ranges, tmp_dir, key="kpi", id_col="id", block_size=100)
        assert set(rows(spark.table("blocked").drop("id_block"))) == want
        after = W.table_partitions(spark, "blocked", ["kpi", "id_block"])
        same = {k for k in before if before[k] == after.get(k)}
        assert {(h["kpi"], str(h["id_block"])) for h in hit} >= {("0", "1"), ("0", "4"), ("1", "9"), ("1", "10"), ("2", "29")}
        assert len(same) == len(before) - 7 and ("0", None) in same and (None, "0") in same


def test_one_of_many_claims_succeeds(spark, tmp_dir):
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append((claim(spark, f"{tmp_dir}/c/1", str(k)), k))) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    won = [k for ok, k in got if ok]
    assert len(won) == 1 and open(f"{tmp_dir}/c/1").read() == str(won[0])


def test_a_lock_of_a_dead_writer_is_taken_over(spark, tmp_dir):
    assert claim(spark, f"{tmp_dir}/lock", "dead")
    with pytest.raises(TimeoutError), exclusive(spark, f"{tmp_dir}/lock", wait=0.3):
        pass
    os.utime(f"{tmp_dir}/lock", (1, 1))
    with exclusive(spark, f"{tmp_dir}/lock"):
        assert os.path.exists(f"{tmp_dir}/lock")
    assert not os.path.exists(f"{tmp_dir}/lock")


def test_versions_conflict_and_update(spark, tmp_dir):
    a, b = (VersionedTable(spark, tmp_dir, "x long") for _ in range(2))
    version, empty = a.read()
    assert (version, empty.count()) == (0, 0)
    assert b.commit(0, spark.range(2).withColumnRenamed("id", "x")) == 1
    with pytest.raises(CommitConflict):
        a.commit(0, spark.range(9).withColumnRenamed("id", "x"))
    a.update(lambda v, r: r.unionByName(spark.createDataFrame([(v + 100,)], "x long")))
    assert rows(b.read()[1]) == [(0,), (1,), (101,)] and rows(b.read(1)[1]) == [(0,), (1,)]


def test_loaders_at_once_start_each_range_once(spark, tmp_dir):
    registry = spark.createDataFrame([(f"k{i}",) for i in range(6)], "kpi string")
    records = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 6).alias("kpi"), "id", F.lit(1.5).alias("v"))
    schema = "kpi string, from_id long, to_id long, status string, created_at timestamp, finished_at timestamp, retries int, details string"
    B.create_blocked_table(spark, "raced", records.limit(0), f"{tmp_dir}/t", key="kpi", id_col="id", block_size=500)
    errors = []

    def run():
        try:
            store = VersionedTable(spark, f"{tmp_dir}/ledger", schema)
            jobs.run_loader(store, registry, records, "raced", "2024-01-01 00:00:00", version_root=f"{tmp_dir}/t", block_size=500)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=run) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    ledger = VersionedTable(spark, f"{tmp_dir}/ledger", schema).read()[1]
    got = ledger.groupBy("kpi", "from_id", "retries").count()
    assert got.filter("count > 1").count() == 0 and ledger.filter("status = 'RUNNING'").count() == 0
    assert rows(spark.table("raced").select("kpi", "id")) == rows(records.select("kpi", "id"))


def test_a_crash_between_rows_and_outcome_loads_once(spark, tmp_dir):
    base = f"{tmp_dir}/in"
    spark.range(5).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b")).repartition(3).write.option("header", True).csv(f"{base}/clicks")
    spark.sql(f"CREATE DATABASE crashed LOCATION '{tmp_dir}/db'")
    store, routes = manifest(spark, f"{tmp_dir}/m"), route_table(spark)
    ok = VersionedTable.update
    try:
        VersionedTable.update = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed"))
        with pytest.raises(RuntimeError):
            load_keys(spark, base, routes, store, "crashed", f"{tmp_dir}/tables", "2024-01-01 00:00:00")
    finally:
        VersionedTable.update = ok
    assert spark.table("crashed.page_clicks").count() == 5 and pending(spark, base, routes, store.read()[1]).count() == 0
    n = pending(spark, base, routes, manifest(spark, f"{tmp_dir}/none").read()[1]).count()
    assert drop_unfinished(spark, store, "crashed", "2024-01-01 12:00:00") == n
    assert spark.table("crashed.page_clicks").count() == 0
    got = load_keys(spark, base, routes, store, "crashed", f"{tmp_dir}/tables", "2024-01-02 00:00:00")
    assert {r["outcome"] for r in got.collect()} == {"loaded"} and sorted(r["a"] for r in spark.table("crashed.page_clicks").collect()) == list("01234")


def test_broken_files_fail_alone_and_replacing_routes_keep_the_newest(spark, tmp_dir):
    base = f"{tmp_dir}/in"
    for prefix in ("clicks", "catalog"):
        os.makedirs(f"{base}/{prefix}")
    for k in range(7):
        with open(f"{base}/clicks/f{k} [x].csv", "w") as f:
            f.write("a,b\n" + ("1,2,3\n" if k == 4 else f"{k},x\n"))
    for k, n in ((0, 3), (1, 4)):
        spark.range(n).coalesce(1).write.parquet(f"{tmp_dir}/made{k}")
        part = next(p for p in os.listdir(f"{tmp_dir}/made{k}") if p.endswith(".parquet"))
        os.link(f"{tmp_dir}/made{k}/{part}", f"{base}/catalog/{k}.parquet")
        os.utime(f"{base}/catalog/{k}.parquet", (10 ** 9 + k, 10 ** 9 + k))
    spark.sql(f"CREATE DATABASE broken LOCATION '{tmp_dir}/db'")
    args = (spark, base, route_table(spark), manifest(spark, f"{tmp_dir}/m"), "broken", f"{tmp_dir}/tables")
    got = {r["key"]: (r["outcome"], r["n_rows"]) for r in load_keys(*args, "2024-01-01 00:00:00").collect()}
    assert got["clicks/f4 [x].csv"] == ("failed", 0) and sum(v == ("loaded", 1) for v in got.values()) == 6
    assert got["catalog/1.parquet"] == ("loaded", 4) and got["catalog/0.parquet"][0] == "replaced" and spark.table("broken.catalog_items").count() == 4
    assert sorted(r["a"] for r in spark.table("broken.page_clicks").collect()) == list("012356")
    again = load_keys(*args, "2024-01-02 00:00:00")
    assert {(r["key"], r["outcome"]) for r in again.collect()} == {("clicks/f4 [x].csv", "failed")}


def test_many_ranges_of_one_key(spark):
    n = 300_000
    rows_ = spark.range(n).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("kpi"), (F.xxhash64("id") % 2_000_000).alias("at"), "id")
    ranges = spark.range(100_000).select(F.lit("hot").alias("kpi"), (F.col("id") * 37 % 2_000_000).alias("from_id"), (F.col("id") * 37 % 2_000_000 + F.col("id") % 9).alias("to_id"))
    covered = ranges.select("kpi", F.explode(F.sequence("from_id", "to_id")).alias("at")).distinct()
    want = rows_.join(covered, ["kpi", "at"], "left_semi").agg(F.count("*"), F.sum("id")).first()
    for sweep in (True, None):
        inside = in_ranges(rows_, ranges, key="kpi", id_col="at", sweep=sweep).agg(F.count("*"), F.sum("id")).first()
        outside = in_ranges(rows_, ranges, key="kpi", id_col="at", how="left_anti", sweep=sweep).agg(F.count("*"), F.sum("id")).first()
        assert tuple(inside) == tuple(want) and inside[0] + outside[0] == n and 0 < inside[0] < n


def test_sweep_edges(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), (None, 5), ("a", 11), ("b", 5), ("a", 5)], "kpi string, id long")
    rng = spark.createDataFrame([("a", 1, 5), ("a", 1, 3), ("a", 7, 6), (None, 0, 9), ("a", None, 99), ("a", 12, 20)], "kpi string, from_id long, to_id long")
    for sweep in (True, False):
        assert rows(in_ranges(df, rng, key="kpi", id_col="id", sweep=sweep)) == [("a", 5), ("a", 5)]
        assert len(rows(in_ranges(df, rng, key="kpi", id_col="id", how="left_anti", sweep=sweep))) == 4
        assert in_ranges(df, rng.limit(0), key="kpi", id_col="id", sweep=sweep).count() == 0
        assert in_ranges(df.limit(0), rng, key="kpi", id_col="id", how="left_anti", sweep=sweep).count() == 0


@pytest.mark.parametrize("bytes_per_split", ["700", "4000", "128m"])
def test_csv_records_cross_lines_and_splits(spark, tmp_dir, bytes_per_split):
    rng = random.Random(7)
    want = []
    for k, cols in enumerate((["id", "b", "c"], ["c", "id", "b"], ["id", "multi\nline"])):
        with open(f"{tmp_dir}/{k}.csv", "w", newline="") as f:
            w = csv.writer(f, lineterminator="\r\n" if k == 1 else "\n")
            w.writerow(cols)
            for i in range(300):
                v = {"id": f"{k}-{i}", "b": rng.choice(["x", "a\nb", 'say "hi"', "", "l1\r\nl2", '"', "\n\n", "com,ma", 'é\n"q"\n☃', "y" * 900 + "\n"]),
                     "c": rng.choice(["1", 't\nu"v"']), "multi\nline": "z"}
                w.writerow([v[c] for c in cols])
                want.append((v["id"], v["b"] or None, v["c"]) if k < 2 else (v["id"], None, None))
    files = [f"{tmp_dir}/{k}.csv" for k in range(3)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for read in (read_csv_records, read_csv_by_header):
            got = read(spark, files)
            assert sorted((r["id"], r["b"], r["c"]) for r in got.collect()) == sorted(want)
            assert "multi\nline" in got.columns
        assert read_csv_records(spark, []) is None
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_first_seen_follows_not_in(spark, tmp_dir):
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    rng = random.Random(3)
    for case in range(3):
        data = [(rng.choice([None, "a", "b", "c", "d", "e"] if case else ["a", "b", "c"]), rng.choice(days)) for _ in range(8)]
        df = spark.createDataFrame(data, "vin string, day string")
        name = f"seen_case_{case}"
        for d in (days[2], days[0], days[1], days[1]):  # any order, twice
            S.record_day(spark, name, df.filter(F.col("day") == d), d, f"{tmp_dir}/{case}", vin="vin")
        state = spark.table(name)
        for d in days:
            today, other = {v for v, x in data if x == d}, {v for v, x in data if x != d}
            new = today if not other else set() if None in other else {v for v in today if v is not None and v not in other}
            mine = df.filter(F.col("day") == d)
            got = S.newly_added_since(state, mine, d, "vin")
            assert {r[0] for r in got.collect()} == new, (case, d, data)
            assert {r[0] for r in S.existing_since(state, mine, d, "vin").collect()} == {v for v in today if v is not None and v in other}
        S.compact_seen(spark, name, f"{tmp_dir}/{case}-v")
        assert spark.table(name).count() == len({v for v, _ in data})
        plan = S.newly_added_since(spark.table(name), spark.createDataFrame([("a",)], "vin string"), days[0], "vin")._jdf.queryExecution().optimizedPlan().toString()
        assert name in plan and "contract" not in plan


def test_partitions_of_a_write_are_added_alone(spark, tmp_dir):
    first = spark.range(60).select("id", (F.col("id") % 30).cast("string").alias("d"))
    W.append_partitions(first, "added", f"{tmp_dir}/a", ["d"])
    os.makedirs(f"{tmp_dir}/a/d=unlisted")  # a listing would find it
    more = spark.createDataFrame([(1, "x/y=1"), (2, None), (3, "3")], "id long, d string")
    assert sorted(map(str, (p["d"] for p in W.append_partitions(more, "added", f"{tmp_dir}/a", ["d"])))) == ["3", "None", "x/y=1"]
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS added").collect()]
    assert len(parts) == 32 and not any("unlisted" in p for p in parts)
    assert spark.table("added").count() == 63 and rows(spark.table("added").filter("d = 'x/y=1' OR d IS NULL")) == [(1, "x/y=1"), (2, None)]


def test_many_keys_share_the_blocks_of_their_group(spark, tmp_dir):
    df = spark.range(4000).select((F.col("id") % 500).cast("string").alias("kpi"), "id", F.lit("old").alias("v"))
    df = df.unionByName(spark.createDataFrame([("0", None, "old"), (None, 5, "old")], "kpi string, id long, v string"))
    how = {"key": "kpi", "id_col": "id", "block_size": 1000, "groups": 3}
    B.create_blocked_table(spark, "grouped", df, tmp_dir, **how)
    before = W.table_partitions(spark, "grouped", ["key_group", "id_block"])
    assert len(before) <= 3 * 5  # 500 keys: not a partition each
    ranges = spark.createDataFrame([("7", 1500, 1900), (None, 0, 10), ("9", None, 5)], "kpi string, from_id long, to_id long")
    new = spark.createDataFrame([("7", 1507, "new"), ("8", 3999, "extra")], "kpi string, id long, v string")
    for _ in range(2):
        want = rows(W.replace_keyed_ranges(spark.table("grouped").select("kpi", "id", "v"), new, ranges, key="kpi", id_col="id"))
        hit = B.replace_ranges_in_blocks(spark, "grouped", new, ranges, tmp_dir, **how)
        assert sorted(rows(spark.table("grouped").select("kpi", "id", "v")), key=str) == sorted(want, key=str)
        after = W.table_partitions(spark, "grouped", ["key_group", "id_block"])
        assert len(hit) == 2 and sum(before[k] == after[k] for k in before) == len(before) - 2


def test_a_block_that_another_writer_changed_is_replaced_again(spark, tmp_dir, monkeypatch):
    df = spark.range(40).select((F.col("id") % 4).cast("string").alias("kpi"), "id", F.lit("old").alias("v"))
    how = {"key": "kpi", "id_col": "id", "block_size": 100, "groups": 1}
    B.create_blocked_table(spark, "contended", df, tmp_dir, **how)
    frame = lambda kpi: (spark.createDataFrame([(kpi, 8 + int(kpi), "new")], "kpi string, id long, v string"),
                         spark.createDataFrame([(kpi, 0, 39)], "kpi string, from_id long, to_id long"))
    commit, other = B.commit_version, []

    def late(*a, **k):
        if not other:
            other.append(1)
            B.replace_ranges_in_blocks(spark, "contended", *frame("1"), tmp_dir, **how)
        return commit(*a, **k)
    monkeypatch.setattr(B, "commit_version", late)
    B.replace_ranges_in_blocks(spark, "contended", *frame("2"), tmp_dir, **how)
    want = [(r["kpi"], r["id"], "old") for r in df.collect() if r["kpi"] in "03"] + [("1", 9, "new"), ("2", 10, "new")]
    assert sorted(rows(spark.table("contended").select("kpi", "id", "v"))) == sorted(want)


def test_the_shared_target_has_few_partitions(spark, tmp_dir):
    from ferrum.plans import catalogue_state as S
    events = spark.range(3000).select(F.col("id").alias("event_id"), (F.col("id") % 600).alias("user_id"), F.lit("view").alias("event_type"),
                                      F.lit(5.0).alias("value"), F.timestamp_seconds(F.col("id") + 1704067200).alias("ts"), F.lit("{}").alias("props"))
    events.write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(1, "AUTOMOBILE")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_dir}/customer.parquet")
    target = S._shared_loader(spark, tmp_dir, lambda r: r)[1]
    assert target.count() >= 3000 and len(target.inputFiles()) <= 2 * S.TARGET_GROUPS
