"""Queries of the operators that keep state between runs: loads by key, shared ledgers, blocked targets, first-seen
tables, alarm calendars, day documents. Same conventions as ``catalogue``, which imports this module at its end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ferrum.plans.catalogue import (
    CONTRACTS_AS_OF, LEDGER_AS_OF, LEDGER_STALE_AFTER, LEDGER_WITH, ORACLE, SQL_FILE_KPIS, SQL_GENERAL,
    SQL_SCAN, T, _consent_3way, _general, _ledger, _ledger_text, _raw_contracts, _records, _sql, register, ts_text,
)
from ferrum.session import scratch_path

# --------------------------------------------------------------------------------------
# Loads by key: landed files by route and day, loaded in four runs.

FIRST_RUN_BEFORE, CHANGED_DAY = "2024/01/10", "2024/01/20"
_SPOILT = "event_id,note\n1,2,3\n"


def _land_by_key(spark, sf_dir, base):
    e = T(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.concat(F.col("event_type"), F.lit(' "q"')).alias("note"),
                                          "event_type", F.date_format("ts", "yyyy/MM/dd").alias("landing"))
    for prefix, kind in (("meters/hourly", "view"), ("sensors/raw", "click"), ("feeds/purchases", "purchase")):
        rows = e.filter(F.col("event_type") == kind).drop("event_type").repartition("landing")
        rows.write.partitionBy("landing").option("header", True).option("quote", "").csv(f"{base}/{prefix}")


def _key_runs(spark, sf_dir):
    """Four runs: the keys of the first days; everything (one file is broken); again; after one file has changed."""
    from ferrum.sinks.loads import load_keys, manifest
    from ferrum.sinks.tables import write_text_file
    from ferrum.sources.routing import landed_keys, route_table
    base, db = scratch_path(spark, "landing"), f"keyed_{uuid.uuid4().hex[:8]}"
    _land_by_key(spark, sf_dir, base)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}-db'")
    store, routes = manifest(spark, f"{base}-manifest"), route_table(spark)
    day = F.regexp_extract(F.url_decode("key"), "landing=([0-9/]+)/", 1)
    load = lambda as_of, keys=None: load_keys(spark, base, routes, store, db, f"{base}-tables", as_of, keys=keys)
    runs = [load("2024-03-01 00:00:00", landed_keys(spark, base).filter(day < FIRST_RUN_BEFORE))]
    write_text_file(spark, f"{base}/feeds/purchases/spoilt.csv", _SPOILT)
    runs.append(load("2024-03-02 00:00:00"))
    runs.append(load("2024-03-03 00:00:00", landed_keys(spark, base).filter("key NOT LIKE '%spoilt.csv'")))
    changed = [r["key"] for r in landed_keys(spark, base).filter((day == CHANGED_DAY) & F.col("key").startswith("meters/")).collect()]
    for k in changed:  # one file; its new content is one row more than its old
        old = spark.read.text(f"{base}/{k}").orderBy(F.col("value") != "event_id,note", "value").collect()
        write_text_file(spark, f"{base}/{k}", "".join(f"{r['value']}\n" for r in old) + "0,added\n")
    runs.append(load("2024-03-04 00:00:00", landed_keys(spark, base).filter("key NOT LIKE '%spoilt.csv'")))
    return runs, db


SQL_KEYED = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type || ' "q"' AS note, strftime(ts, '%Y/%m/%d') AS landing,
           CASE event_type WHEN 'view' THEN 'meter_hourly' WHEN 'click' THEN 'sensor_raw' ELSE 'purchases' END AS target_table
    FROM events WHERE event_type IN ('view', 'click', 'purchase')
"""


@register("load_keys", _sql("""
    WITH l AS {l},
    runs AS (SELECT target_table, CASE WHEN landing < '2024/01/10' THEN 1 ELSE 2 END AS run, count(*) AS n_rows FROM l GROUP BY 1, 2
             UNION ALL SELECT 'meter_hourly', 4, count(*) + 1 FROM l WHERE target_table = 'meter_hourly' AND landing = '2024/01/20' HAVING count(*) > 0)
    SELECT run, target_table, 'loaded' AS outcome, CAST(n_rows AS BIGINT) AS n_rows FROM runs
    UNION ALL SELECT 2, 'purchases', 'failed', 0
""", l=SQL_KEYED))
def q_load_keys(spark, sf_dir):
    """Rows loaded per run, table and outcome. The first run is given the keys of the first days, the second loads
    the rest and reports a broken file alone, the third finds nothing to do, the fourth loads a changed file again."""
    runs, _ = _key_runs(spark, sf_dir)
    out = None
    for i, rows in enumerate(runs):
        part = rows.groupBy("target_table", "outcome").agg(F.sum("n_rows").alias("n_rows")).select(F.lit(i + 1).alias("run"), "target_table", "outcome", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("load_keys_rows", _sql("""
    WITH l AS {l}, changed AS (SELECT * FROM l WHERE target_table = 'meter_hourly' AND landing = '2024/01/20')
    SELECT target_table, event_id, note FROM l UNION ALL SELECT target_table, event_id, note FROM changed
    UNION ALL SELECT 'meter_hourly', '0', 'added' FROM (SELECT count(*) AS n FROM changed) c WHERE n > 0
""", l=SQL_KEYED))
def q_load_keys_rows(spark, sf_dir):
    """The tables after the four runs: every file once, the changed one a second time with its new content."""
    _, db = _key_runs(spark, sf_dir)
    out = None
    for t in ("meter_hourly", "sensor_raw", "purchases"):
        rows = spark.table(f"{db}.{t}").select(F.lit(t).alias("target_table"), "event_id", "note")
        out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------------------------------------------------
# Ledger shared by loaders, target by blocks, many ranges of a hot key.

TARGET_BLOCK, TARGET_GROUPS = 10_000, 8


def _shared_loader(spark, sf_dir, preload=None):
    """Two loaders on one ledger, the second started between the first one's reading and its commit:
    (ledger, target table)."""
    from ferrum.operators import ledger as L
    from ferrum.plans import jobs
    from ferrum.sinks.blocks import create_blocked_table
    from ferrum.sinks.versions import VersionedTable
    ledger, registry = _ledger(spark, sf_dir)
    records = _records(spark, sf_dir)
    root, name = scratch_path(spark, "shared-loader"), f"shared_{uuid.uuid4().hex[:8]}"
    ledger = ledger.select(L.LEDGER_COLUMNS)
    store = VersionedTable(spark, f"{root}/ledger", ledger.schema)
    store.commit(0, ledger)
    first = spark.createDataFrame([], records.schema) if preload is None else preload(records)
    create_blocked_table(spark, name, first, f"{root}/target", key="kpi", id_col="id", block_size=TARGET_BLOCK, groups=TARGET_GROUPS)

    class Late(VersionedTable):
        """Its first commit comes after another loader has started its jobs."""
        other = None

        def commit(self, version, rows):
            if self.other is None:
                self.other = jobs.start_jobs(store, registry, LEDGER_AS_OF, stale_after=LEDGER_STALE_AFTER)
            return super().commit(version, rows)

    late, where = Late(spark, f"{root}/ledger", ledger.schema), {"version_root": f"{root}/target", "block_size": TARGET_BLOCK, "groups": TARGET_GROUPS}
    jobs.run_loader(late, registry, records, name, LEDGER_AS_OF, stale_after=LEDGER_STALE_AFTER, **where)
    jobs.finish_jobs(store, late.other, records, name, LEDGER_AS_OF, **where)
    return store.read()[1], spark.table(name)


@register("loader_pair", ORACLE["incremental_load"])
def q_loader_pair(spark, sf_dir):
    """Two loader runs at once on one ledger. The later commit is refused, that loader reads again and
    finds every KPI running; each range is started once and the ledger is that of one run."""
    return _ledger_text(_shared_loader(spark, sf_dir)[0])


@register("incremental_blocks", f"""
    {LEDGER_WITH}, S AS ({SQL_SCAN}),
    G AS (SELECT kpi, job_from_id, max(id) AS max_id FROM S GROUP BY kpi, job_from_id),
    D AS (SELECT * FROM G WHERE max_id <> 0 AND max_id - job_from_id >= 100),
    P AS (SELECT CAST(user_id AS VARCHAR) AS kpi, event_id AS id, 'old' AS event_type, value FROM events WHERE event_id % 3 = 0)
    SELECT S.kpi, S.id, S.event_type, S.value FROM S JOIN D ON S.kpi = D.kpi AND S.job_from_id = D.job_from_id
    UNION ALL
    SELECT * FROM P WHERE NOT EXISTS (SELECT 1 FROM D WHERE D.kpi = P.kpi AND P.id BETWEEN D.job_from_id AND D.max_id)
""")
def q_incremental_blocks(spark, sf_dir):
    """The target of the loader, filled before, laid out by (group of kpis, id block): rows inside the loaded
    ranges are replaced, the others stay, and only blocks that a range meets are rewritten."""
    old = lambda r: r.filter("id % 3 = 0").withColumn("event_type", F.lit("old"))
    return _shared_loader(spark, sf_dir, old)[1].select("kpi", "id", "event_type", "value")


SQL_HOT_RANGES = """
    SELECT CASE WHEN o_custkey % 3 = 0 THEN 'hot' ELSE CAST(o_custkey % 50 AS VARCHAR) END AS kpi,
           o_orderkey * 3 AS from_id, o_orderkey * 3 + o_custkey % 4 AS to_id FROM orders
"""
SQL_HOT_ROWS = """
    SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'hot' ELSE CAST(l_suppkey % 50 AS VARCHAR) END AS kpi,
           l_orderkey * 3 + l_linenumber AS id, l_partkey FROM lineitem
"""


@register("range_sweep", _sql("""
    WITH r AS {r}, l AS {l}, covered AS (SELECT DISTINCT kpi, unnest(generate_series(from_id, to_id)) AS id FROM r)
    SELECT l.kpi, l.id, l.l_partkey, c.id IS NOT NULL AS inside FROM l LEFT JOIN covered c ON l.kpi = c.kpi AND l.id = c.id
""", r=SQL_HOT_RANGES, l=SQL_HOT_ROWS))
def q_range_sweep(spark, sf_dir):
    """Half of all rows and a third of all ranges belong to one key; both sides of the split, by one sorted pass."""
    from ferrum.operators.joins import in_ranges
    o, li = T(spark, sf_dir, "orders"), T(spark, sf_dir, "lineitem")
    ranges = o.select(F.when(F.col("o_custkey") % 3 == 0, "hot").otherwise((F.col("o_custkey") % 50).cast("string")).alias("kpi"),
                      (F.col("o_orderkey") * 3).alias("from_id"), (F.col("o_orderkey") * 3 + F.col("o_custkey") % 4).alias("to_id"))
    rows = li.select(F.when(F.col("l_suppkey") % 2 == 0, "hot").otherwise((F.col("l_suppkey") % 50).cast("string")).alias("kpi"),
                     (F.col("l_orderkey") * 3 + F.col("l_linenumber")).alias("id"), "l_partkey")
    inside = in_ranges(rows, ranges, key="kpi", id_col="id", sweep=True).withColumn("inside", F.lit(True))
    outside = in_ranges(rows, ranges, key="kpi", id_col="id", how="left_anti", sweep=True).withColumn("inside", F.lit(False))
    return inside.unionByName(outside)


@register("manual_range", """
    SELECT CAST(user_id AS VARCHAR) AS kpi, event_id AS id, event_type,
           CASE WHEN event_id BETWEEN 200 AND 1500 THEN 'v2' ELSE 'v1' END AS version
    FROM events
""")
def q_manual_range(spark, sf_dir):
    """A manual pull of one id range replaces exactly that range of the target, run twice."""
    from ferrum.operators.ledger import id_range
    from ferrum.sinks.writers import commit_version, replace_range
    records = _records(spark, sf_dir).drop("value")
    name, root = f"manual_{uuid.uuid4().hex[:8]}", scratch_path(spark, "manual")
    commit_version(spark, name, records.withColumn("version", F.lit("v1")), root)
    for _ in range(2):
        pulled = id_range(records, "id", 200, "bounded", to_id=1500).withColumn("version", F.lit("v2"))
        commit_version(spark, name, replace_range(spark.table(name), pulled, "id", 200, 1500), root)
    return spark.table(name)


@register("replace_where", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN 'v2' ELSE 'v1' END AS version FROM orders
""")
def q_replace_where(spark, sf_dir):
    """K7 with an extra predicate: rows of one status above a price are replaced, the others of that status stay."""
    from ferrum.sinks.writers import commit_version, replace_where
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    name, root = f"where_{uuid.uuid4().hex[:8]}", scratch_path(spark, "where")
    commit_version(spark, name, o.withColumn("version", F.lit("v1")), root)
    hit = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000)
    new = o.filter(hit).withColumn("version", F.lit("v2"))
    commit_version(spark, name, replace_where(spark.table(name), new, hit), root)
    return spark.table(name).select("o_orderkey", "o_orderstatus", "version")


@register("partition_append", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows FROM events GROUP BY 1, 2
""")
def q_partition_append(spark, sf_dir):
    """A table of many partitions, then the last days are appended; each write makes its own partitions readable."""
    from ferrum.sinks.writers import append_partitions
    e = T(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    name, path = f"appended_{uuid.uuid4().hex[:8]}", scratch_path(spark, "appended")
    for part in (e.filter("day < '2024-01-25'"), e.filter("day >= '2024-01-25'")):
        append_partitions(part, name, path, ["event_type", "day"])
    return spark.table(name).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------------------
# First seen, alarms, streams.

SEEN_DAYS = ("1998-03-28", "1998-03-29", "1998-03-30")


@register("first_seen_days", """
    WITH h AS (SELECT CAST(o_custkey AS VARCHAR) AS vin, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
               WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-03-31'),
    d AS (SELECT day FROM (VALUES ('1998-03-28'), ('1998-03-29'), ('1998-03-30')) v(day))
    SELECT DISTINCT d.day, h.vin, CASE WHEN EXISTS (SELECT 1 FROM h o WHERE o.vin = h.vin AND o.day < d.day) THEN 'known' ELSE 'new' END AS kind
    FROM d JOIN h ON h.day = d.day
""")
def q_first_seen_days(spark, sf_dir):
    """Three days in a row. Each day asks a maintained first-seen table about its own vehicles, then adds them."""
    from ferrum.operators import seen as S
    o = T(spark, sf_dir, "orders").filter("o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-03-31'")
    h = o.select(F.col("o_custkey").cast("string").alias("vin"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    name, root = f"seen_{uuid.uuid4().hex[:8]}", scratch_path(spark, "seen")
    past = h.filter(F.col("day") < SEEN_DAYS[0]).select("vin", F.to_date("day").alias("first_day"), F.to_date("day").alias("last_day"))
    from ferrum.sinks.writers import append_to_table
    append_to_table(S.compacted(past), name, f"{root}/first")
    out = None
    for day in SEEN_DAYS:
        today = h.filter(F.col("day") == day)
        S.record_day(spark, name, today, day, f"{root}/first", vin="vin")
        state = spark.table(name)
        # The table goes on changing; what it says today is kept.
        for kind, ask in (("new", S.newly_added_since), ("known", S.existing_since)):
            path = scratch_path(spark, "seen-answer")
            ask(state, today, day, "vin").write.parquet(path)
            part = spark.read.schema("vin string").parquet(path).select(F.lit(day).alias("day"), "vin", F.lit(kind).alias("kind"))
            out = part if out is None else out.unionByName(part)
        S.compact_seen(spark, name, f"{root}/versions")
    return out


SQL_CALENDAR = """
    SELECT p.ws AS window_start, k.event_type, w.stat, CASE WHEN w.stat <= 50 THEN 'ALARM' ELSE 'OK' END AS state
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:45:00', INTERVAL 15 MINUTE)) AS ws) p
    CROSS JOIN (SELECT DISTINCT event_type FROM events) k
    LEFT JOIN (SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS ws, event_type, min(value) AS stat FROM events GROUP BY 1, 2) w
      ON w.ws = p.ws AND w.event_type = k.event_type
"""


def _calendar(spark, sf_dir):
    from ferrum.operators.kpi import alarm_calendar
    e = T(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    return alarm_calendar(e, "ts", "value", keys=["event_type"], start="2024-01-01 00:00:00", end="2024-01-31 00:00:00", threshold=50.0)


@register("alarm_calendar", _sql("""
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, stat, state FROM {c} c
""", c=SQL_CALENDAR))
def q_alarm_calendar(spark, sf_dir):
    """The alarm state of every period of every key; a silent period is OK."""
    return _calendar(spark, sf_dir).select(ts_text("window_start").alias("window_start"), "event_type", "stat", "state")


@register("alarm_transitions", _sql("""
    WITH l AS (SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY event_type ORDER BY window_start) AS state_before FROM {c} c)
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, state_before, state FROM l WHERE state <> state_before
""", c=SQL_CALENDAR))
def q_alarm_transitions(spark, sf_dir):
    """One row per change OK -> ALARM -> OK."""
    from ferrum.operators.kpi import alarm_transitions
    got = alarm_transitions(_calendar(spark, sf_dir), ["event_type"])
    return got.withColumn("window_start", ts_text("window_start"))


@register("stream_landing_once", ORACLE["stream_landing"])
def q_stream_landing_once(spark, sf_dir):
    """Every message is delivered twice, the second time after a restart of the stream, and lands once."""
    from ferrum.plans.standins import queue_messages
    from ferrum.streaming.landing import land_messages, read_landed
    root = scratch_path(spark, "queue-once")
    messages = queue_messages(T(spark, sf_dir, "events")).select("received_at", "body")
    for delivery in (messages, messages.withColumn("received_at", F.col("received_at") + F.expr("INTERVAL 2 HOURS"))):
        delivery.write.mode("append").json(f"{root}/in")
        q = land_messages(spark, f"{root}/in", f"{root}/landed", f"{root}/checkpoint", once_within="40 days")
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return read_landed(spark, f"{root}/landed").groupBy("msg_type", "landing_date", "country").agg(F.count(F.lit(1)).alias("n_messages"))


# --------------------------------------------------------------------------------------
# Documents, messages, jobs.

def _day_docs(spark, sf_dir):
    """One nested document per day, landed as files: purchases above 100 are clients; every seventh day has an error,
    every tenth an empty document, every eleventh is a list around its document."""
    from ferrum.sources.days import day_documents, read_day_documents, wanted_days
    e = T(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    hit = (F.col("event_type") == "purchase") & (F.col("value") > 100)
    client = F.when(hit, F.struct(F.col("user_id").alias("id"), F.struct("value", F.col("event_id").alias("event")).alias("last")))
    docs = e.groupBy("day").agg(F.collect_list(client).alias("clients"))
    n = F.dayofmonth("day")
    body = F.to_json(F.struct("clients"))
    text = (F.when(n % 7 == 0, F.lit('{"error": "busy", "clients": []}')).when(n % 10 == 0, F.lit("{}"))
            .when(n % 11 == 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body))
    root = scratch_path(spark, "day-documents")
    # One row, one document, one file of its day.
    docs.select(text.alias("value"), F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("_clients.json")).alias("file")).repartition("file").write.partitionBy("file").text(root)
    found = read_day_documents(spark, root, r"(\d{4}-\d{2}-\d{2})_clients")
    return day_documents(wanted_days(spark, "2023-12-30", "2024-02-02"), found)


SQL_DAYS = """
    SELECT w.day, d.day IS NULL OR day(w.day) % 7 = 0 OR day(w.day) % 10 = 0 AS bad, coalesce(d.n, 0) AS n
    FROM (SELECT CAST(generate_series AS DATE) AS day FROM generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) w
    LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'purchase' AND value > 100) AS n FROM events GROUP BY 1) d ON w.day = d.day
"""


@register("day_documents", _sql("""
    SELECT strftime(day, '%Y-%m-%d') AS day, CASE WHEN bad THEN 'error' WHEN n = 0 THEN 'empty' ELSE 'loaded' END AS status,
           CASE WHEN NOT bad THEN n END AS n_clients, CASE WHEN bad THEN 'x' END AS failed
    FROM {d} d
""", d=SQL_DAYS))
def q_day_documents(spark, sf_dir):
    """Wanted days against landed nested documents: missing, empty or with an error -> error, no clients -> empty."""
    d = _day_docs(spark, sf_dir)
    return d.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "status", "n_clients",
                    F.when(F.col("message").isNotNull(), "x").alias("failed"))


@register("day_records", _sql("""
    SELECT strftime(d.day, '%Y-%m-%d') AS day, e.user_id AS client_id, e.event_id AS event, e.value, 'prod' AS api_environment
    FROM {d} d JOIN events e ON CAST(e.ts AS DATE) = d.day AND e.event_type = 'purchase' AND e.value > 100 WHERE NOT d.bad
""", d=SQL_DAYS))
def q_day_records(spark, sf_dir):
    """The clients of the loaded days, one record each, through a pluggable processor."""
    from ferrum.sources.days import client_records
    fields = {"client_id": "$.id bigint", "event": "$.last.event bigint", "value": "$.last.value double"}
    rows = client_records(_day_docs(spark, sf_dir), fields, lambda df: df.withColumn("api_environment", F.lit("prod")))
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("csv_breaks", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || chr(10) || 'said "' || c_mktsegment || '", twice' AS note,
           CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS segment
    FROM customer
""")
def q_csv_breaks(spark, sf_dir):
    """S3: records with line breaks, doubled quotes and separators inside quotes, in files with columns in two orders."""
    from ferrum.sources.files import list_files, read_csv_by_header
    c = T(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").cast("string").alias("c_custkey"), F.concat("c_name", F.lit('\nsaid "'), "c_mktsegment", F.lit('", twice')).alias("note"),
                    F.col("c_mktsegment").alias("segment"))
    root = scratch_path(spark, "csv-breaks")
    w = {"header": True, "quote": '"', "escape": '"'}
    rows.filter("c_custkey % 2 = 0").select("note", "c_custkey").write.options(**w).csv(f"{root}/a")
    rows.filter("c_custkey % 2 = 1").write.options(**w).csv(f"{root}/b")
    return read_csv_by_header(spark, list_files(spark, root, pattern=".*\\.csv")).drop("__path")


@register("header_subscription", _sql("""
    SELECT g.commission_number, g.ifa_order_key, g.source_timestamp, count(*) AS n_links, 1 AS n_index
    FROM {g} g JOIN {g} s ON s.commission_number = g.commission_number AND s.ifa_order_key = g.ifa_order_key GROUP BY 1, 2, 3
""", g=SQL_GENERAL))
def q_header_subscription(spark, sf_dir):
    """Headers meet their subscriptions through fk_subscription = index, and every header has one index of its own."""
    from ferrum.operators.messages import message_headers, subscriptions
    g = _general(spark, sf_dir)
    h, s = message_headers(g), subscriptions(g)
    j = h.join(s.select(F.col("index").alias("sub_index"), F.col("commission_number").alias("sub_number"), F.col("ifa_order_key").alias("sub_key")),
               F.col("fk_subscription") == F.col("sub_index"))
    j = j.filter((F.col("sub_number") == F.col("commission_number")) & (F.col("sub_key") == F.col("ifa_order_key")))
    return j.groupBy("commission_number", "ifa_order_key", ts_text("source_timestamp").alias("source_timestamp")).agg(
        F.count(F.lit(1)).alias("n_links"), F.countDistinct("index").cast("int").alias("n_index"))


@register("message_fields", """
    SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, value,
           CASE WHEN event_type = 'signup' THEN NULL ELSE upper(event_type) END AS msg_type FROM events
""")
def q_message_fields(spark, sf_dir):
    """landed message texts parsed into typed fields and written as text again."""
    from ferrum.plans.standins import queue_messages
    path = scratch_path(spark, "bodies")
    queue_messages(T(spark, sf_dir, "events")).select("body").write.text(path)
    schema = "type string, event_id bigint, user_id bigint, value double"
    once = spark.read.text(path).select(F.from_json("value", schema).alias("m"))
    again = once.select(F.from_json(F.to_json("m"), schema).alias("m"))
    return again.select("m.event_id", "m.user_id", "m.value", F.col("m.type").alias("msg_type"))


@register("literal_rows", """
    SELECT c_custkey AS id, c_name AS name, 'row' AS origin FROM customer
    UNION ALL SELECT 0, 'O''Neil', 'values' UNION ALL SELECT -1, NULL, 'values' UNION ALL SELECT -2, 'inline', 'inline'
""")
def q_literal_rows(spark, sf_dir):
    """Rows of a frame, of INSERT VALUES and of an inline frame in one table."""
    from ferrum.sinks.tables import create_users_table, insert_values
    from ferrum.sources.files import inline_rows
    name = f"literal_{uuid.uuid4().hex[:8]}"
    create_users_table(spark, name, scratch_path(spark, "literal"))
    c = T(spark, sf_dir, "customer")
    origin = lambda x: F.lit(x).alias("tel")
    none = F.lit(None).cast("string").alias("email")
    c.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"), none, origin("row")).write.insertInto(name)
    insert_values(spark, name, [(0, "O'Neil", None, "values"), (-1, None, None, "values")])
    inline_rows(spark, [(-2, "inline")], "id int, name string").select("id", "name", none, origin("inline")).write.insertInto(name)
    return spark.table(name).select(F.col("id").cast("long").alias("id"), "name", F.col("tel").alias("origin"))


ALERT_DAYS = ("2001-06-01", "2001-07-01", "2001-09-01")


@register("contract_alerts", _sql("""
    WITH k AS {k},
    f AS (SELECT strftime(strptime(substr(filename, 1, 8), '%Y%m%d'), '%Y-%m-%d') AS day, n_contracts FROM k)
    SELECT 'kpi alarm' AS subject, day, 'file_rows' AS name, CAST(n_contracts AS DOUBLE) AS value, 'ALARM' AS state
    FROM f WHERE day IN ('2001-06-01', '2001-07-01') AND n_contracts <= 100000000
    UNION ALL SELECT 'missing drop', '2001-09-01', '01.09.2001', 0.0, 'ALARM'
""", k=SQL_FILE_KPIS))
def q_contract_alerts(spark, sf_dir):
    """The contract job of three days, its alerts included: a KPI at or below its threshold, and a day without a drop."""
    from ferrum.plans.jobs import contract_day
    root = scratch_path(spark, "contract-days")
    raw = _raw_contracts(spark, sf_dir).drop("contract_id", "event_timestamp")
    raw.withColumnRenamed("filename", "landing_file").write.partitionBy("landing_file").option("header", True).csv(f"{root}/drops")
    sfx, consent = uuid.uuid4().hex[:8], _consent_3way(spark, sf_dir)
    for n, day in enumerate(ALERT_DAYS):
        as_of = f"2001-08-0{n + 2} {CONTRACTS_AS_OF[11:]}"
        alerts = contract_day(spark, f"{root}/drops", day, consent, as_of, out_root=root, contracts_table=f"day_contracts_{sfx}",
                              kpi_table_name=f"day_kpis_{sfx}", alerts_table=f"day_alerts_{sfx}", name_from="parent",
                              alarms={"file_rows": 1e8, "file_vehicles": -1.0})
    return alerts.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
