"""Query catalogue: every operator of the inventory run on the driver tables.

Each entry is a ``(spark, sf_dir) -> DataFrame`` callable plus, where the result
is expressible in SQL, the equivalent DuckDB query over the same parquet tables.
Output conventions shared by both sides: timestamps are rendered as
``yyyy-MM-dd HH:mm:ss`` text, every computed column is aliased, hash ids are
left out of compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrum.session import ensure_utc, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def ts_text(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


# --------------------------------------------------------------------------------------
# Stand-in projections in SQL (kept next to each other so both engines share one rule).

SQL_SIGNALS = """
    SELECT CAST(user_id AS VARCHAR) AS vin, ts, event_type AS signal_name, value AS signal_value
    FROM events
"""

SQL_CONTRACTS = """
    SELECT o_orderkey AS contract_id,
           CAST(o_custkey AS VARCHAR) AS vin,
           o_orderpriority AS category,
           o_orderstatus AS product,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS inception_date,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY AS TIMESTAMP) AS contract_end_date,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE ROUND(o_totalprice / 1000, 2) END AS duration,
           strftime(o_orderdate, '%Y%m') || '01_contracts.csv' AS filename,
           o_orderdate AS event_timestamp
    FROM orders
"""

SQL_CONSENT_3WAY = """
    SELECT CAST(c.c_custkey AS VARCHAR) AS vehicle_vin, c.c_name, n.n_name, r.r_name
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE n.n_name LIKE '%1%' AND c.c_mktsegment = 'BUILDING' AND r.r_name = 'ASIA'
"""


def _sql(template: str, **parts: str) -> str:
    return template.format(**{k: f"({v})" for k, v in parts.items()})


# --------------------------------------------------------------------------------------
# 1. Signals

SIGNALS_AS_OF = "2024-02-01 00:00:00"


@register("ingest_signals", _sql("""
    SELECT vin,
           CAST(floor(epoch(date_trunc('second', ts))) AS BIGINT) AS observed_unix,
           CAST(1706745600 AS BIGINT) AS processed_unix,
           CAST(year(ts) AS INTEGER) AS observed_year,
           CAST(month(ts) AS INTEGER) AS observed_month,
           CAST(day(ts) AS INTEGER) AS observed_day,
           signal_value, signal_name
    FROM {s} s
""", s=SQL_SIGNALS))
def q_ingest_signals(spark, sf_dir):
    """Raw JSON signals landed, read back, normalised."""
    from ferrum.operators.signals import normalize_signals
    from ferrum.plans.standins import signals_from_events
    from ferrum.sources.files import read_json

    raw = signals_from_events(T(spark, sf_dir, "events"))
    path = scratch_path(spark, "raw-signals")
    raw.write.mode("overwrite").json(path)
    landed = read_json(spark, path, schema="vin string, eventDate string, signalName string, signalValue double")
    return normalize_signals(landed, SIGNALS_AS_OF)


@register("ingest_partitions", """
    SELECT event_type AS signal_name, CAST(year(ts) AS INTEGER) AS observed_year,
           CAST(month(ts) AS INTEGER) AS observed_month, count(*) AS n_rows
    FROM events GROUP BY 1, 2, 3
""")
def q_ingest_partitions(spark, sf_dir):
    """Partitioned append (salted clustering), partitions discovered on read."""
    from ferrum.operators.signals import SIGNAL_PARTITION_COLUMNS, normalize_signals
    from ferrum.plans.standins import signals_from_events
    from ferrum.sinks.writers import partitioned_write

    sig = normalize_signals(signals_from_events(T(spark, sf_dir, "events")), SIGNALS_AS_OF)
    path = scratch_path(spark, "signals")
    partitioned_write(sig, path, SIGNAL_PARTITION_COLUMNS)
    import uuid as _uuid

    from ferrum.sources.sql import register_partitioned_table
    back = register_partitioned_table(spark, f"signals_{_uuid.uuid4().hex[:8]}", path)
    return back.groupBy(*SIGNAL_PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------------------
# 2. Contracts, consent, KPIs

SQL_RAW_CONTRACTS = """
    SELECT o_orderkey AS contract_id,
           CAST(o_custkey AS VARCHAR) AS vehicleIdentificationNumber,
           o_orderpriority AS subscriptionVehicleCategory,
           o_orderstatus AS product,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'not-a-date'
                ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS inceptionDate,
           strftime(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY, '%Y-%m-%d') AS contractEndDate,
           CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS duration,
           strftime(o_orderdate, '%Y%m') || '01_contracts.csv' AS filename,
           o_orderdate AS event_timestamp
    FROM orders
"""

CONTRACTS_AS_OF = "2001-08-02 06:30:15"


def _raw_contracts(spark, sf_dir):
    from ferrum.plans.standins import contracts_from_orders
    return contracts_from_orders(T(spark, sf_dir, "orders"))


def _stored_contracts(spark, sf_dir):
    """Typed contracts as stored, with their original load time and the contract id."""
    from ferrum.functions.dates import parse_timestamp
    raw = _raw_contracts(spark, sf_dir)
    return raw.select(
        "contract_id",
        F.col("vehicleIdentificationNumber").alias("vehicle_identification_number"),
        parse_timestamp("inceptionDate").alias("inception_date"),
        "event_timestamp", "filename")


def _consent_3way(spark, sf_dir):
    """Three-way consent join, stand-in form: customer x nation x region, four filters."""
    from ferrum.operators.joins import filtered_join_chain
    c, n, r = T(spark, sf_dir, "customer"), T(spark, sf_dir, "nation"), T(spark, sf_dir, "region")
    j = filtered_join_chain(
        c, F.col("c_mktsegment") == "BUILDING",
        [(n, "c_nationkey", "n_nationkey", F.col("n_name").contains("1")),
         (r, "n_regionkey", "r_regionkey", F.col("r_name") == "ASIA")])
    return j.select(F.col("c_custkey").cast("string").alias("vehicle_vin"), "c_name", "n_name", "r_name")


@register("consent_three_way", _sql("SELECT * FROM {c} c", c=SQL_CONSENT_3WAY))
def q_consent_three_way(spark, sf_dir):
    """Three inner joins with four filters; fixed-size dimensions broadcast."""
    return _consent_3way(spark, sf_dir)


SQL_CONSENT_SOURCES = """
    WITH user_mgmt AS (
        SELECT CAST(c_custkey AS VARCHAR) AS vehicle_vin, c_custkey AS aopuser_ssoid,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'PRIMARY' ELSE 'SECONDARY' END AS permission_userrole,
               c_name AS client_id_array
        FROM customer),
    consent_document AS (
        SELECT o_custkey AS cust_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_latest FROM orders),
    cust AS (
        SELECT c_custkey AS cust_id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_deleted_flag FROM customer)
"""


@register("consent_vehicles", SQL_CONSENT_SOURCES + """
    SELECT u.vehicle_vin
    FROM user_mgmt u
    JOIN consent_document d ON u.aopuser_ssoid = d.cust_id
    JOIN cust c ON u.aopuser_ssoid = c.cust_id
    WHERE u.client_id_array LIKE '%12%' AND u.permission_userrole = 'PRIMARY'
      AND d.is_latest = 1 AND c.is_deleted_flag = 0
""")
def q_consent_vehicles(spark, sf_dir):
    """The consent query in its three-source shape (user management x
    consent documents x customers, joined on the user id, bag semantics)."""
    from ferrum.operators.consent import consent_vehicles
    c, o = T(spark, sf_dir, "customer"), T(spark, sf_dir, "orders")
    user_mgmt = c.select(
        F.col("c_custkey").cast("string").alias("vehicle_vin"), F.col("c_custkey").alias("aopuser_ssoid"),
        F.when(F.col("c_mktsegment") == "BUILDING", "PRIMARY").otherwise("SECONDARY").alias("permission_userrole"),
        F.col("c_name").alias("client_id_array"))
    documents = o.select(F.col("o_custkey").alias("cust_id"),
                         F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_latest"))
    customers = c.select(F.col("c_custkey").alias("cust_id"),
                         F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("is_deleted_flag"))
    return consent_vehicles(user_mgmt, documents, customers, client_id="12", role="PRIMARY")


@register("consent_join", _sql("""
    SELECT c.vehicleIdentificationNumber, c.subscriptionVehicleCategory, c.product,
           c.inceptionDate, c.contractEndDate, c.duration
    FROM {raw} c JOIN {con} k ON c.vehicleIdentificationNumber = k.vehicle_vin
""", raw=SQL_RAW_CONTRACTS, con=SQL_CONSENT_3WAY))
def q_consent_join(spark, sf_dir):
    """Contracts of consenting vehicles (inner join, 6 columns)."""
    from ferrum.operators.consent import filter_by_consent
    return filter_by_consent(_raw_contracts(spark, sf_dir), _consent_3way(spark, sf_dir))


@register("typed_contracts", _sql("""
    SELECT vehicleIdentificationNumber AS vehicle_identification_number,
           subscriptionVehicleCategory AS subscription_vehicle_category, product,
           strftime(TRY_CAST(inceptionDate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS inception_date,
           strftime(TRY_CAST(contractEndDate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS contract_end_date,
           TRY_CAST(duration AS DOUBLE) AS duration,
           '2001-08-02 06:30:15' AS event_timestamp, filename
    FROM {raw} r
""", raw=SQL_RAW_CONTRACTS))
def q_typed_contracts(spark, sf_dir):
    """All-string contract rows typed with coercing casts."""
    from ferrum.operators.contracts import typed_contracts
    out = typed_contracts(_raw_contracts(spark, sf_dir), CONTRACTS_AS_OF)
    return out.withColumns({c: ts_text(c) for c in ("inception_date", "contract_end_date", "event_timestamp")})


@register("not_in_consent", _sql("""
    SELECT o_orderkey AS contract_id, CAST(o_custkey AS VARCHAR) AS vehicle_identification_number
    FROM orders
    WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT vehicle_vin FROM {con} k)
""", con=SQL_CONSENT_3WAY))
def q_not_in_consent(spark, sf_dir):
    """Stored contracts whose vehicle is NOT IN the consent list."""
    from ferrum.operators.consent import contracts_without_consent
    stored = _stored_contracts(spark, sf_dir)
    out = contracts_without_consent(stored, _consent_3way(spark, sf_dir))
    return out.select("contract_id", "vehicle_identification_number")


SQL_CONSENT_WITH_NULLS = """
    SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS vehicle_vin
    FROM customer WHERE c_mktsegment = 'BUILDING'
"""


@register("not_in_consent_null", _sql("""
    SELECT o_orderkey AS contract_id, CAST(o_custkey AS VARCHAR) AS vehicle_identification_number
    FROM orders
    WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT vehicle_vin FROM {con} k)
""", con=SQL_CONSENT_WITH_NULLS))
def q_not_in_consent_null(spark, sf_dir):
    """J3 with a NULL inside the NOT IN set: SQL semantics give no row."""
    from ferrum.operators.consent import contracts_without_consent
    c = T(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    consent = c.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).alias("vehicle_vin"))
    out = contracts_without_consent(_stored_contracts(spark, sf_dir), consent)
    return out.select("contract_id", "vehicle_identification_number")


@register("vins_without_consent", _sql("""
    SELECT count(DISTINCT CAST(o_custkey AS VARCHAR)) AS n_vins_without_consent
    FROM orders
    WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT vehicle_vin FROM {con} k)
""", con=SQL_CONSENT_3WAY))
def q_vins_without_consent(spark, sf_dir):
    """A5: distinct stored vehicles whose consent is gone."""
    from ferrum.operators.consent import contracts_without_consent
    out = contracts_without_consent(_stored_contracts(spark, sf_dir), _consent_3way(spark, sf_dir))
    return out.agg(F.countDistinct("vehicle_identification_number").alias("n_vins_without_consent"))


NEW_VINS_AS_OF = "2001-01-05 09:00:00"


@register("newly_added", """
    SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS vehicle_identification_number
    FROM orders
    WHERE CAST(o_orderdate AS DATE) = DATE '2001-01-05'
      AND CAST(o_custkey AS VARCHAR) NOT IN (
          SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE CAST(o_orderdate AS DATE) <> DATE '2001-01-05')
""")
def q_newly_added(spark, sf_dir):
    """Vehicles first seen on the as-of day (NOT IN over all other days)."""
    from ferrum.operators.consent import newly_added_vehicles
    return newly_added_vehicles(_stored_contracts(spark, sf_dir), NEW_VINS_AS_OF)


@register("existing_vins", """
    SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS vehicle_identification_number
    FROM orders
    WHERE CAST(o_orderdate AS DATE) = DATE '2001-01-05'
      AND CAST(o_custkey AS VARCHAR) IN (
          SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE CAST(o_orderdate AS DATE) <> DATE '2001-01-05')
""")
def q_existing_vins(spark, sf_dir):
    """Vehicles seen on the as-of day and on another day (semi join)."""
    from ferrum.operators.consent import existing_vehicles
    return existing_vehicles(_stored_contracts(spark, sf_dir), NEW_VINS_AS_OF)


SQL_FILE_KPIS = _sql("""
    WITH cs AS (SELECT DISTINCT vehicle_vin FROM {con} k),
    per AS (
        SELECT filename, count(*) AS n_contracts,
               count(DISTINCT vehicleIdentificationNumber) AS n_unique_vins,
               count(DISTINCT CASE WHEN cs.vehicle_vin IS NOT NULL THEN vehicleIdentificationNumber END)
                   AS n_vins_with_consent
        FROM {raw} c LEFT JOIN cs ON c.vehicleIdentificationNumber = cs.vehicle_vin
        GROUP BY filename)
    SELECT filename, n_contracts, n_unique_vins, (SELECT count(*) FROM cs) AS n_consent_total,
           n_vins_with_consent, n_unique_vins - n_vins_with_consent AS n_vins_without_consent
    FROM per
""", con=SQL_CONSENT_3WAY, raw=SQL_RAW_CONTRACTS)


@register("kpis", SQL_FILE_KPIS)
def q_kpis(spark, sf_dir):
    """A1-A4: per-file contract and consent counts in one pass."""
    from ferrum.operators.consent import file_kpis
    return file_kpis(_raw_contracts(spark, sf_dir), _consent_3way(spark, sf_dir))


KPI_AS_OF = "2001-08-02 06:30:00"


@register("kpi_table", _sql("""
    WITH k AS {k},
    w AS (
        SELECT count(DISTINCT CAST(o_custkey AS VARCHAR)) AS n
        FROM orders WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT vehicle_vin FROM {con} c)),
    longf AS (
        SELECT 'file_rows' AS kpi_name, n_contracts AS v, filename AS context FROM k
        UNION ALL SELECT 'file_vehicles', n_unique_vins, filename FROM k
        UNION ALL SELECT 'consenting_vehicles', n_consent_total, filename FROM k
        UNION ALL SELECT 'file_vehicles_consenting', n_vins_with_consent, filename FROM k
        UNION ALL SELECT 'file_vehicles_refused', n_vins_without_consent, filename FROM k
        UNION ALL SELECT 'contracts_stored_without_consent', n, 'n/a' FROM w)
    SELECT kpi_name, CAST(CAST(ROUND(CAST(v AS DOUBLE), 4) AS DECIMAL(18,4)) AS DOUBLE) AS kpi_value,
           'Count' AS unit, '2001-08-02 06:30:00' AS kpi_timestamp, 'Interface' AS category,
           'Pipeline' AS sub_category, context, '1' AS version, 'dev' AS environment
    FROM longf
""", k=SQL_FILE_KPIS, con=SQL_CONSENT_3WAY))
def q_kpi_table(spark, sf_dir):
    """File metrics unpivoted to the KPI fact table, merged with a
    stored-data metric set."""
    from ferrum.operators.consent import file_kpis
    from ferrum.operators.kpi import FILE_METRIC_NAMES, kpi_table, merge_metric_sets
    consent = _consent_3way(spark, sf_dir)
    per_file = kpi_table(file_kpis(_raw_contracts(spark, sf_dir), consent), FILE_METRIC_NAMES,
                         as_of=KPI_AS_OF, context_col="filename")
    stored = q_vins_without_consent(spark, sf_dir)
    stored_set = kpi_table(stored, {"n_vins_without_consent": "contracts_stored_without_consent"},
                           as_of=KPI_AS_OF)
    out = merge_metric_sets(per_file, stored_set)
    return out.withColumns({"kpi_value": F.col("kpi_value").cast("double"),
                            "kpi_timestamp": ts_text("kpi_timestamp")})


@register("kpi_alarm", """
    SELECT strftime(time_bucket(INTERVAL 15 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES, '%Y-%m-%d %H:%M:%S') AS window_end,
           event_type, min(value) AS stat,
           CASE WHEN min(value) <= 5 THEN 'ALARM' ELSE 'OK' END AS state
    FROM events GROUP BY time_bucket(INTERVAL 15 MINUTES, ts), event_type
""")
def q_kpi_alarm(spark, sf_dir):
    """A15 T4 (batch form): 900 s tumbling min per type, ALARM when <= 5."""
    from ferrum.operators.kpi import window_alarm
    ev = T(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    out = window_alarm(ev, "ts", "value", period_seconds=900, threshold=5.0, keys=["event_type"])
    return out.withColumns({"window_start": ts_text("window_start"), "window_end": ts_text("window_end")})


# --------------------------------------------------------------------------------------
# 3. Retention and monitoring

RETENTION_AS_OF = "2001-08-01 00:00:00"
RETENTION_DAYS = 700
ERASE_RULES = {365: "o_orderpriority", 700: "o_totalprice,o_orderstatus"}


def _orders_with_ts(spark, sf_dir):
    return T(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "event_timestamp")


@register("error_alarm", """
    SELECT strftime(time_bucket(INTERVAL 15 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES, '%Y-%m-%d %H:%M:%S') AS window_end,
           user_bucket, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) AS stat,
           CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) >= 1 THEN 'ALARM' ELSE 'OK' END AS state
    FROM (SELECT *, CASE WHEN user_id < 75 THEN 'low' ELSE 'high' END AS user_bucket FROM events) e
    GROUP BY time_bucket(INTERVAL 15 MINUTES, ts), user_bucket
""")
def q_error_alarm(spark, sf_dir):
    """A15 (sum rule): per 900 s and user group, the number of error events; ALARM at >= 1."""
    from ferrum.operators.kpi import window_alarm
    ev = T(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("user_id") < 75, "low").otherwise("high").alias("user_bucket"),
        (F.col("event_type") == "error").cast("double").alias("is_error"))
    out = window_alarm(ev, "ts", "is_error", period_seconds=900, threshold=1.0, statistic="sum",
                       comparison=">=", keys=["user_bucket"])
    return out.withColumns({"window_start": ts_text("window_start"), "window_end": ts_text("window_end")})


@register("retention_delete", """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS event_timestamp
    FROM orders
    WHERE NOT coalesce(date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 700, false)
""")
def q_retention_delete(spark, sf_dir):
    """Rows at least 700 calendar days old are removed; NULL age kept."""
    from ferrum.operators.retention import retention_delete
    kept = retention_delete(_orders_with_ts(spark, sf_dir), "event_timestamp", RETENTION_AS_OF, RETENTION_DAYS)
    return kept.select("o_orderkey", "o_custkey", ts_text("event_timestamp").alias("event_timestamp"))


@register("retention_null", """
    SELECT o_orderkey,
           CASE WHEN date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 365
                THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 700
                THEN NULL ELSE o_totalprice END AS o_totalprice,
           CASE WHEN date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 700
                THEN NULL ELSE o_orderstatus END AS o_orderstatus
    FROM orders
""")
def q_retention_null(spark, sf_dir):
    """R2: listed columns set to NULL once older than their own limit."""
    from ferrum.operators.retention import erase_columns
    out = erase_columns(_orders_with_ts(spark, sf_dir), "event_timestamp", RETENTION_AS_OF, ERASE_RULES)
    return out.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")


def _retained(spark, sf_dir):
    """Retention on a plain, a partitioned and a bucketed table, a table without age and a view: (report, database)."""
    import uuid as _uuid

    from ferrum.operators.retention import apply_retention_to_database
    root = scratch_path(spark, "retention")
    db = f"retention_{_uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}.db'")
    orders = _orders_with_ts(spark, sf_dir)
    items = T(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "event_timestamp")
    orders.write.option("path", f"{root}/landed/contracts").saveAsTable(f"{db}.contracts")
    items.write.partitionBy("l_returnflag").option("path", f"{root}/landed/shipments").saveAsTable(f"{db}.shipments")
    orders.write.bucketBy(4, "o_custkey").sortBy("o_custkey").option("path", f"{root}/landed/bucketed").saveAsTable(f"{db}.bucketed")
    T(spark, sf_dir, "customer").write.option("path", f"{root}/landed/customers").saveAsTable(f"{db}.customers")
    spark.sql(f"CREATE VIEW {db}.recent AS SELECT * FROM {db}.contracts")
    report = apply_retention_to_database(spark, db, "event_timestamp", RETENTION_AS_OF, RETENTION_DAYS, ERASE_RULES, f"{root}/versions")
    return report, db


@register("retention_schema", """
    SELECT n.name AS table_name, count(*) AS rows_before,
           count(*) FILTER (WHERE date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 700) AS rows_removed,
           count(*) FILTER (WHERE NOT coalesce(date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 700, false)) AS rows_after,
           'ok' AS status
    FROM orders, (VALUES ('contracts'), ('bucketed')) AS n(name) GROUP BY n.name
    UNION ALL
    SELECT 'shipments', count(*),
           count(*) FILTER (WHERE date_diff('day', l_shipdate, TIMESTAMP '2001-08-01 00:00:00') >= 700),
           count(*) FILTER (WHERE NOT coalesce(date_diff('day', l_shipdate, TIMESTAMP '2001-08-01 00:00:00') >= 700, false)),
           'ok'
    FROM lineitem
    UNION ALL
    SELECT 'customers', NULL, NULL, NULL, 'skipped: no column event_timestamp'
    UNION ALL
    SELECT 'recent', NULL, NULL, NULL, 'skipped: view'
""")
def q_retention_schema(spark, sf_dir):
    """Retention applied to every table of a database, one report row each."""
    return _retained(spark, sf_dir)[0]


@register("retention_rows", """
    SELECT n.name AS table_name, o_orderkey AS id, CASE WHEN date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 365
                THEN NULL ELSE o_orderpriority END AS detail, count(*) AS n
    FROM orders, (VALUES ('contracts'), ('bucketed')) AS n(name)
    WHERE NOT coalesce(date_diff('day', o_orderdate, TIMESTAMP '2001-08-01 00:00:00') >= 700, false) GROUP BY ALL
    UNION ALL
    SELECT 'shipments', l_orderkey, l_returnflag, count(*) FROM lineitem
    WHERE NOT coalesce(date_diff('day', l_shipdate, TIMESTAMP '2001-08-01 00:00:00') >= 700, false) GROUP BY ALL
""")
def q_retention_rows(spark, sf_dir):
    """The rows that retention leaves in a plain, a partitioned and a bucketed table (the last
    read with a grouping on its bucket column)."""
    _, db = _retained(spark, sf_dir)
    plain = spark.table(f"{db}.contracts").groupBy(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("detail"))
    parts = spark.table(f"{db}.shipments").groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("detail"))
    bucketed = spark.table(f"{db}.bucketed").groupBy("o_custkey", F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("detail"))
    out = [g.count().withColumn("table_name", F.lit(n)) for n, g in (("contracts", plain), ("shipments", parts), ("bucketed", bucketed))]
    return out[0].unionByName(out[1]).unionByName(out[2].drop("o_custkey")).withColumnRenamed("count", "n")


MONITOR_COUNTRY = "NATION_1"
MONITOR_AS_OF = "1998-08-02 00:00:00"

SQL_VEHICLE = """
    SELECT CAST(o_custkey AS VARCHAR) AS commission_number,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS ifa_order_key,
           o_orderdate AS event_timestamp
    FROM orders
"""
SQL_DEALERS = """
    SELECT CAST(c_custkey AS VARCHAR) AS commission_number, n_name AS dealership_country
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def _vehicle_and_dealers(spark, sf_dir):
    from ferrum.plans.standins import dealer_countries, vehicles_from_orders
    return (vehicles_from_orders(T(spark, sf_dir, "orders")),
            dealer_countries(T(spark, sf_dir, "customer"), T(spark, sf_dir, "nation")))


@register("missing_messages", _sql("""
    SELECT DISTINCT commission_number, ifa_order_key, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp
    FROM {v} v
    WHERE commission_number IN (SELECT DISTINCT commission_number FROM {d} d WHERE dealership_country = 'NATION_1')
      AND ifa_order_key IS NULL
""", v=SQL_VEHICLE, d=SQL_DEALERS))
def q_missing_messages(spark, sf_dir):
    """Vehicles of a country that never received a message."""
    from ferrum.operators.monitor import missing_messages
    v, d = _vehicle_and_dealers(spark, sf_dir)
    return missing_messages(v, d, MONITOR_COUNTRY).withColumn("event_timestamp", ts_text("event_timestamp"))


@register("stale_updates", _sql("""
    SELECT DISTINCT commission_number, ifa_order_key, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp
    FROM {v} v
    WHERE commission_number IN (SELECT DISTINCT commission_number FROM {d} d WHERE dealership_country = 'NATION_1')
      AND date_diff('day', event_timestamp, TIMESTAMP '1998-08-02 00:00:00') > 1
""", v=SQL_VEHICLE, d=SQL_DEALERS))
def q_stale_updates(spark, sf_dir):
    """Vehicles of a country not updated for more than one day."""
    from ferrum.operators.monitor import stale_updates
    v, d = _vehicle_and_dealers(spark, sf_dir)
    return stale_updates(v, d, MONITOR_COUNTRY, MONITOR_AS_OF).withColumn("event_timestamp", ts_text("event_timestamp"))


@register("freshness_alerts", _sql("""
    WITH v AS (SELECT DISTINCT * FROM {v} x),
    d AS (SELECT DISTINCT commission_number, dealership_country FROM {d} y),
    j AS (SELECT * FROM v JOIN d USING (commission_number)),
    c AS (
        SELECT dealership_country, 'missing_messages' AS "check",
               count(*) FILTER (WHERE ifa_order_key IS NULL) AS n_rows FROM j GROUP BY 1
        UNION ALL
        SELECT dealership_country, 'missing_updates',
               count(*) FILTER (WHERE date_diff('day', event_timestamp, TIMESTAMP '1998-08-02 00:00:00') > 1)
        FROM j GROUP BY 1)
    SELECT 'DEV-' || dealership_country || ' - vehicle monitoring - ' || replace("check", '_', ' ') AS subject,
           "check", dealership_country AS country, n_rows
    FROM c WHERE n_rows > 0
""", v=SQL_VEHICLE, d=SQL_DEALERS))
def q_freshness_alerts(spark, sf_dir):
    """Alert rows for both checks and every country in one pass."""
    from ferrum.operators.monitor import freshness_alerts
    v, d = _vehicle_and_dealers(spark, sf_dir)
    return freshness_alerts(v, d, MONITOR_AS_OF)


@register("missing_days", """
    SELECT strftime(d, '%Y-%m-%d') AS day, strftime(d, '%d.%m.%Y') AS day_text,
           'missing input file for ' || strftime(d, '%d.%m.%Y') AS subject
    FROM (SELECT CAST(generate_series AS DATE) AS d
          FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) g
    WHERE d NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events)
""")
def q_missing_days(spark, sf_dir):
    """Expected days without any landed event."""
    from ferrum.operators.monitor import missing_days
    return missing_days(T(spark, sf_dir, "events"), "ts", "2024-01-01", "2024-01-31")


# --------------------------------------------------------------------------------------
# 4. Messages

MESSAGES_EVENT_TS = "2024-02-01 00:00:00"


def _parsed(spark, bodies, sample, name):
    """Land the generated messages as JSON-lines files, then read them back with
    the schema of the sample document: the real input path of the flattening jobs.
    ``name`` is the logical source file name carried into the output."""
    from ferrum.sources.files import read_json, sample_text_schema
    path = scratch_path(spark, "messages")
    bodies.select("body").write.text(path)
    df = read_json(spark, path, schema=sample_text_schema(spark, sample))
    return df.withColumn("filename", F.lit(name))


def _general(spark, sf_dir):
    from ferrum.operators.messages import SAMPLE_GENERAL_INFORMATION, general_info
    from ferrum.plans.standins import general_information_messages
    msgs = _parsed(spark, general_information_messages(T(spark, sf_dir, "orders")), SAMPLE_GENERAL_INFORMATION,
                   "general_information.json")
    return general_info(msgs, MESSAGES_EVENT_TS)


def _checkpoint_msgs(spark, sf_dir):
    from ferrum.operators.messages import SAMPLE_CHECKPOINT
    from ferrum.plans.standins import checkpoint_messages
    return _parsed(spark, checkpoint_messages(T(spark, sf_dir, "orders"), T(spark, sf_dir, "lineitem")),
                   SAMPLE_CHECKPOINT, "checkpoint.json")


SQL_CHECKPOINT_ROWS = """
    SELECT 'CHECKPOINT' AS msg_type, CAST(o_orderkey AS VARCHAR) AS commission_number,
           lpad(CAST(o_custkey AS VARCHAR), 13, '0') AS ifa_order_key,
           CAST(l_linenumber AS BIGINT) AS checkpoint_number,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS checkpoint_timestamp,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS source_timestamp,
           'checkpoint.json' AS filename, o_orderpriority
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
"""


def _checkpoint_out(df):
    return df.select("msg_type", "commission_number", "ifa_order_key", "checkpoint_number",
                     ts_text("checkpoint_timestamp").alias("checkpoint_timestamp"),
                     ts_text("source_timestamp").alias("source_timestamp"), "filename")


@register("checkpoint_explode", _sql("""
    SELECT msg_type, commission_number, ifa_order_key, checkpoint_number, checkpoint_timestamp,
           source_timestamp, filename FROM {c} c
""", c=SQL_CHECKPOINT_ROWS))
def q_checkpoint_explode(spark, sf_dir):
    """Nested CHECKPOINT messages parsed with a sample-document schema, exploded."""
    from ferrum.operators.messages import checkpoints
    return _checkpoint_out(checkpoints(_checkpoint_msgs(spark, sf_dir), MESSAGES_EVENT_TS))


@register("parts_explode", """
    SELECT 'PARTS' AS msg_type, CAST(o_orderkey AS VARCHAR) AS commission_number,
           lpad(CAST(o_custkey AS VARCHAR), 13, '0') AS ifa_order_key,
           strftime(o_orderdate, '%Y-%m-%d') AS itemization_date,
           p_type AS family, CAST(p_partkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS number,
           p_brand AS origin
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
""")
def q_parts_explode(spark, sf_dir):
    """Nested PARTS messages exploded to one row per part."""
    from ferrum.operators.messages import SAMPLE_PARTS, parts
    from ferrum.plans.standins import parts_messages
    msgs = _parsed(spark, parts_messages(T(spark, sf_dir, "orders"), T(spark, sf_dir, "lineitem"),
                                         T(spark, sf_dir, "part")), SAMPLE_PARTS, "parts.json")
    out = parts(msgs, MESSAGES_EVENT_TS)
    return out.select("msg_type", "commission_number", "ifa_order_key",
                      F.date_format("itemization_date", "yyyy-MM-dd").alias("itemization_date"),
                      "family", "number", "origin")


SQL_GENERAL = """
    SELECT 'GENERAL_INFORMATION' AS msg_type, CAST(o_orderkey AS VARCHAR) AS commission_number,
           lpad(CAST(o_custkey AS VARCHAR), 13, '0') AS ifa_order_key,
           'VIN' || lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS vin,
           strftime(o_orderdate, '%Y-%m-%d') AS order_date,
           CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BRAND-C' WHEN '2' THEN 'BRAND-V'
                WHEN '3' THEN 'BRAND-N' ELSE 'Other' END AS brand,
           o_orderstatus AS model, CAST(year(o_orderdate) AS BIGINT) AS model_year,
           o_orderpriority AS model_group, CAST(o_custkey AS VARCHAR) AS ordering_dealer_id,
           strftime(o_orderdate, '%Y-%m-%d') AS cp8_date,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS source_timestamp,
           '2024-02-01 00:00:00' AS event_timestamp, 'general_information.json' AS filename
    FROM orders
"""


@register("general_info", SQL_GENERAL)
def q_general_info(spark, sf_dir):
    """GENERAL_INFORMATION messages flattened one row per message."""
    g = _general(spark, sf_dir)
    return g.select("msg_type", "commission_number", "ifa_order_key", "vin",
                    F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
                    "brand", "model", "model_year", "model_group", "ordering_dealer_id",
                    F.date_format("cp8_date", "yyyy-MM-dd").alias("cp8_date"),
                    ts_text("source_timestamp").alias("source_timestamp"),
                    ts_text("event_timestamp").alias("event_timestamp"), "filename")


@register("brand_filter", _sql("""
    SELECT msg_type, commission_number, ifa_order_key, checkpoint_number, checkpoint_timestamp,
           source_timestamp, filename
    FROM {c} c WHERE substr(o_orderpriority, 1, 1) = '1'
""", c=SQL_CHECKPOINT_ROWS))
def q_brand_filter(spark, sf_dir):
    """Checkpoints restricted to the (commission, order key) pairs of one brand."""
    from ferrum.operators.messages import brand_keys, checkpoints
    keys = brand_keys(_general(spark, sf_dir), ["BRAND-C"])
    return _checkpoint_out(checkpoints(_checkpoint_msgs(spark, sf_dir), MESSAGES_EVENT_TS, keys))


@register("subscription", _sql("""
    SELECT event_timestamp, msg_type, commission_number,
           CAST(NULL AS VARCHAR) AS start_of_subscription, CAST(NULL AS VARCHAR) AS start_of_unsubscription,
           ifa_order_key
    FROM {g} g
""", g=SQL_GENERAL))
def q_subscription(spark, sf_dir):
    """Subscription rows (hash id left out of the compared output)."""
    from ferrum.operators.messages import subscriptions
    s = subscriptions(_general(spark, sf_dir), "GENERAL_INFORMATION")
    return s.select(ts_text("event_timestamp").alias("event_timestamp"), "msg_type", "commission_number",
                    ts_text("start_of_subscription").alias("start_of_subscription"),
                    ts_text("start_of_unsubscription").alias("start_of_unsubscription"), "ifa_order_key")


@register("msg_header", _sql("""
    SELECT event_timestamp, msg_type, commission_number, source_timestamp,
           source_timestamp AS msg_timestamp, ifa_order_key, filename
    FROM {g} g
""", g=SQL_GENERAL))
def q_msg_header(spark, sf_dir):
    """Header rows; ids are hashes, left out of the compared output."""
    from ferrum.operators.messages import message_headers
    h = message_headers(_general(spark, sf_dir), "MSG_HEADER")
    return h.select(ts_text("event_timestamp").alias("event_timestamp"), "msg_type", "commission_number",
                    ts_text("source_timestamp").alias("source_timestamp"),
                    ts_text("msg_timestamp").alias("msg_timestamp"), "ifa_order_key", "filename")


@register("union_final_partial", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
""")
def q_union_final_partial(spark, sf_dir):
    """Bag union of final and partial rows."""
    from ferrum.operators.messages import union_final_partial
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return union_final_partial(o.filter(F.col("o_orderstatus") != "F"), o.filter(F.col("o_orderstatus") == "F"))


@register("route_messages", """
    SELECT event_id, msg_type, 'DE' AS country, strftime(ts, '%Y-%m-%d') AS landing_date,
           'DE/' || strftime(ts, '%Y-%m-%d') || '/' || msg_type || '/' || strftime(ts, '%Y-%m-%d--%H:%M:%S.%f')
           || '--' || lower(msg_type) || '.json' AS landing_key
    FROM (SELECT *, CASE WHEN event_type = 'signup' THEN 'unknown' ELSE upper(event_type) END AS msg_type
          FROM events) e
""")
def q_route_messages(spark, sf_dir):
    """Message type with default and the landing key of every message."""
    from ferrum.operators.messages import route_messages
    from ferrum.plans.standins import queue_messages
    out = route_messages(queue_messages(T(spark, sf_dir, "events")))
    return out.select("event_id", "msg_type", "country", "landing_date", "landing_key")


# --------------------------------------------------------------------------------------
# 5. Job ledger and id ranges

LEDGER_AS_OF = "2024-01-30 12:00:00"
LEDGER_STALE_AFTER = "1 day"
LEDGER_TS = "TIMESTAMP '2024-01-30 12:00:00'"

SQL_LEDGER = """
    WITH b AS (
        SELECT CAST(user_id AS VARCHAR) AS kpi, CAST(floor(event_id / 100) * 100 AS BIGINT) AS from_id, event_id,
               CASE WHEN event_type = 'view' AND value < 3 THEN 'RUNNING'
                    WHEN event_type = 'error' AND value < 10 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               ts AS created_at, event_type AS details
        FROM events)
    SELECT kpi, from_id, CASE WHEN status = 'SUCCESS' THEN from_id + 99 END AS to_id, status, created_at,
           CASE WHEN status <> 'RUNNING' THEN created_at + INTERVAL 5 MINUTE END AS finished_at,
           CAST(row_number() OVER (PARTITION BY kpi, from_id ORDER BY event_id) - 1 AS INTEGER) AS retries, details
    FROM b
"""
SQL_REGISTRY = """
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS kpi FROM events
    UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
"""
SQL_FAILED = f"""
    SELECT f.kpi, f.from_id, f.retries
    FROM (SELECT kpi, from_id, max(retries) AS retries FROM L
          WHERE status = 'FAILED' AND finished_at IS NOT NULL GROUP BY kpi, from_id) f
    LEFT JOIN (SELECT kpi, from_id, max(retries) AS retries FROM L
               WHERE (status = 'RUNNING' AND finished_at IS NULL) OR (status = 'SUCCESS' AND finished_at IS NOT NULL)
               GROUP BY kpi, from_id) r
      ON f.kpi = r.kpi AND f.from_id = r.from_id AND f.retries = r.retries - 1
    WHERE r.retries IS NULL
"""
SQL_NEXT = f"""
    n AS (SELECT kpi, count(from_id) AS n_jobs, max(to_id) AS max_to FROM L GROUP BY kpi),
    run AS (SELECT DISTINCT kpi FROM L WHERE status = 'RUNNING' AND finished_at IS NULL
            AND created_at + INTERVAL 1 DAY > {LEDGER_TS}),
    st AS (SELECT kpi, from_id, retries FROM (
             SELECT kpi, from_id, retries, row_number() OVER (PARTITION BY kpi ORDER BY from_id, retries) AS rn
             FROM L WHERE status = 'RUNNING' AND finished_at IS NULL AND created_at + INTERVAL 1 DAY < {LEDGER_TS}) x
           WHERE rn = 1),
    fl AS (SELECT kpi, from_id, retries FROM (
             SELECT kpi, from_id, retries, row_number() OVER (PARTITION BY kpi ORDER BY from_id, retries) AS rn
             FROM ({SQL_FAILED}) y) z WHERE rn = 1),
    A0 AS (
        SELECT R.kpi,
               CASE WHEN coalesce(n.n_jobs, 0) = 0 THEN 'first_run'
                    WHEN run.kpi IS NOT NULL THEN 'wait'
                    WHEN st.kpi IS NOT NULL THEN 'retry_stale'
                    WHEN fl.kpi IS NOT NULL THEN 'retry_failed'
                    ELSE 'new' END AS action,
               n.max_to, st.from_id AS st_from, st.retries AS st_r, fl.from_id AS fl_from, fl.retries AS fl_r
        FROM R LEFT JOIN n ON R.kpi = n.kpi LEFT JOIN run ON R.kpi = run.kpi
        LEFT JOIN st ON R.kpi = st.kpi LEFT JOIN fl ON R.kpi = fl.kpi),
    A1 AS (
        SELECT kpi, action,
               CAST(CASE action WHEN 'first_run' THEN 0 WHEN 'retry_stale' THEN st_from
                    WHEN 'retry_failed' THEN fl_from WHEN 'new' THEN coalesce(max_to, 0) + 1 END AS BIGINT) AS from_id,
               CAST(CASE action WHEN 'first_run' THEN 0 WHEN 'new' THEN 0 WHEN 'retry_stale' THEN st_r + 1
                    WHEN 'retry_failed' THEN fl_r + 1 END AS INTEGER) AS retries
        FROM A0),
    A AS (SELECT *, CASE WHEN retries >= 2 THEN 'bounded' WHEN retries IS NOT NULL THEN 'unbounded' END AS mode
          FROM A1)
"""
LEDGER_WITH = f"WITH L AS ({SQL_LEDGER}), R AS ({SQL_REGISTRY}), {SQL_NEXT}"


def _ledger(spark, sf_dir):
    from ferrum.plans.standins import kpi_registry, ledger_from_events
    ev = T(spark, sf_dir, "events")
    return ledger_from_events(ev), kpi_registry(ev, T(spark, sf_dir, "customer"))


def _actions(spark, sf_dir):
    from ferrum.operators.ledger import next_actions
    ledger, registry = _ledger(spark, sf_dir)
    return next_actions(registry, ledger, LEDGER_AS_OF, stale_after=LEDGER_STALE_AFTER)


def _ledger_text(df):
    return df.withColumns({"created_at": ts_text("created_at"), "finished_at": ts_text("finished_at")})


@register("ledger_running", f"""
    WITH L AS ({SQL_LEDGER})
    SELECT kpi, from_id, retries, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
           CASE WHEN created_at + INTERVAL 1 DAY > {LEDGER_TS} THEN 'running' ELSE 'stale' END AS state
    FROM L WHERE status = 'RUNNING' AND finished_at IS NULL AND created_at + INTERVAL 1 DAY <> {LEDGER_TS}
""")
def q_ledger_running(spark, sf_dir):
    """Open jobs split into running and stale by age."""
    from ferrum.operators.ledger import running_jobs
    ledger, _ = _ledger(spark, sf_dir)
    return running_jobs(ledger, LEDGER_AS_OF, LEDGER_STALE_AFTER).withColumn("created_at", ts_text("created_at"))


@register("ledger_failed", f"WITH L AS ({SQL_LEDGER}) {SQL_FAILED}")
def q_ledger_failed(spark, sf_dir):
    """Failed ranges without a newer attempt (one aggregate, no self join)."""
    from ferrum.operators.ledger import failed_jobs
    ledger, _ = _ledger(spark, sf_dir)
    return failed_jobs(ledger)


@register("ledger_next", f"{LEDGER_WITH} SELECT kpi, action, from_id, retries, mode FROM A")
def q_ledger_next(spark, sf_dir):
    """Next action of every KPI by strict priority."""
    return _actions(spark, sf_dir)


@register("ledger_apply", f"""
    {LEDGER_WITH},
    C AS (SELECT kpi, from_id, retries - 1 AS retries FROM A WHERE action = 'retry_stale'),
    U AS (
        SELECT L.kpi, L.from_id, L.to_id,
               CASE WHEN C.kpi IS NOT NULL AND L.status = 'RUNNING' AND L.finished_at IS NULL THEN 'FAILED' ELSE L.status END AS status,
               L.created_at,
               CASE WHEN C.kpi IS NOT NULL AND L.status = 'RUNNING' AND L.finished_at IS NULL THEN {LEDGER_TS} ELSE L.finished_at END AS finished_at,
               L.retries,
               CASE WHEN C.kpi IS NOT NULL AND L.status = 'RUNNING' AND L.finished_at IS NULL THEN 'STALE JOB' ELSE L.details END AS details
        FROM L LEFT JOIN C ON L.kpi = C.kpi AND L.from_id = C.from_id AND L.retries = C.retries
        UNION ALL
        SELECT kpi, from_id, CAST(NULL AS BIGINT), 'RUNNING', {LEDGER_TS}, CAST(NULL AS TIMESTAMP), retries, CAST(NULL AS VARCHAR)
        FROM A WHERE action <> 'wait')
    SELECT kpi, from_id, to_id, status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
           strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS finished_at, retries, details
    FROM U
""")
def q_ledger_apply(spark, sf_dir):
    """Stale jobs closed as FAILED, one RUNNING row appended per started job."""
    from ferrum.operators.ledger import apply_actions, next_actions
    ledger, registry = _ledger(spark, sf_dir)
    actions = next_actions(registry, ledger, LEDGER_AS_OF, stale_after=LEDGER_STALE_AFTER)
    return _ledger_text(apply_actions(ledger, actions, LEDGER_AS_OF))


def _records(spark, sf_dir):
    """Source records of the incremental load: events keyed by user, id = event id."""
    return T(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("kpi"), F.col("event_id").alias("id"), "event_type", "value")


SQL_SCAN = """
    SELECT CAST(e.user_id AS VARCHAR) AS kpi, e.event_id AS id, e.event_type, e.value,
           A.from_id AS job_from_id, A.retries AS job_retries, A.mode AS job_mode
    FROM events e JOIN A ON CAST(e.user_id AS VARCHAR) = A.kpi AND e.event_id >= A.from_id
         AND (A.mode <> 'bounded' OR e.event_id <= A.from_id + 1000)
    WHERE A.from_id IS NOT NULL
"""


@register("scan_preview", f"{LEDGER_WITH}, S AS ({SQL_SCAN}) SELECT * FROM S ORDER BY id, kpi, job_from_id LIMIT 50")
def q_scan_preview(spark, sf_dir):
    """O3: the first 50 records of a pull, as logged (a top-n report)."""
    from ferrum.operators.ledger import preview, scan_ranges
    return preview(scan_ranges(_records(spark, sf_dir), _actions(spark, sf_dir)), ["id", "kpi", "job_from_id"])


@register("id_range_scan", f"{LEDGER_WITH} {SQL_SCAN}")
def q_id_range_scan(spark, sf_dir):
    """Records of every job's id range (unbounded from_id.. or bounded batch)."""
    from ferrum.operators.ledger import scan_ranges
    return scan_ranges(_records(spark, sf_dir), _actions(spark, sf_dir))


@register("range_validate", f"""
    {LEDGER_WITH}, S AS ({SQL_SCAN}),
    G AS (SELECT kpi, job_from_id, count(*) AS n_rows, max(id) AS max_id FROM S GROUP BY kpi, job_from_id),
    V AS (
        SELECT A.kpi, A.from_id, A.retries, A.mode, coalesce(G.n_rows, 0) AS n_rows, G.max_id,
               CASE WHEN coalesce(G.n_rows, 0) = 0 THEN 'empty'
                    WHEN G.max_id = 0 OR G.max_id < A.from_id THEN 'invalid'
                    WHEN G.max_id - A.from_id < 100 THEN 'too_small' ELSE 'load' END AS outcome
        FROM A LEFT JOIN G ON A.kpi = G.kpi AND A.from_id = G.job_from_id
        WHERE A.from_id IS NOT NULL)
    SELECT *, outcome = 'load' AS success, CASE WHEN outcome = 'load' THEN max_id END AS to_id FROM V
""")
def q_range_validate(spark, sf_dir):
    """Outcome of every pulled range (empty / invalid / too small / load)."""
    from ferrum.operators.ledger import scan_ranges, validate_ranges
    actions = _actions(spark, sf_dir)
    return validate_ranges(actions, scan_ranges(_records(spark, sf_dir), actions))


# --------------------------------------------------------------------------------------
# 6. Sinks, routed loads, file layouts

def _versioned_table(spark, name_hint):
    import uuid as _uuid
    return f"{name_hint}_{_uuid.uuid4().hex[:8]}", scratch_path(spark, name_hint)


@register("range_replace", f"""
    WITH L AS ({SQL_LEDGER})
    SELECT CAST(e.user_id AS VARCHAR) AS kpi, e.event_id AS id, e.value,
           CASE WHEN EXISTS (SELECT 1 FROM L WHERE L.status = 'SUCCESS' AND L.kpi = CAST(e.user_id AS VARCHAR)
                             AND e.event_id BETWEEN L.from_id AND L.to_id) THEN 'v2' ELSE 'v1' END AS version
    FROM events e
""")
def q_range_replace(spark, sf_dir):
    """Delete every loaded id range and insert its re-pulled rows,
    committed as a new table version (idempotent: rows never duplicate)."""
    from ferrum.plans.standins import ledger_from_events
    from ferrum.sinks.writers import commit_version, replace_keyed_ranges
    records = _records(spark, sf_dir).select("kpi", "id", "value")
    name, root = _versioned_table(spark, "landed_records")
    commit_version(spark, name, records.withColumn("version", F.lit("v1")), root)
    ranges = (ledger_from_events(T(spark, sf_dir, "events")).filter(F.col("status") == "SUCCESS")
              .select("kpi", "from_id", "to_id").distinct())
    from ferrum.operators.joins import in_ranges
    pulled = in_ranges(records, ranges, key="kpi", id_col="id")
    result = replace_keyed_ranges(spark.table(name), pulled.withColumn("version", F.lit("v2")), ranges,
                                  key="kpi", id_col="id")
    commit_version(spark, name, result, root)
    return spark.table(name)


@register("partition_replace", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, 'prod' AS api_environment,
           CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 'v2' ELSE 'v1' END AS version
    FROM events
""")
def q_partition_replace(spark, sf_dir):
    """K7: reload of three days replaces exactly those (date, environment) partitions."""
    from ferrum.sinks.writers import overwrite_partitions
    ev = T(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lit("prod").alias("api_environment"))
    path = scratch_path(spark, "daily")
    overwrite_partitions(ev.withColumn("version", F.lit("v1")), path, ["date", "api_environment"])
    batch = ev.filter(F.col("date").between("2024-01-10", "2024-01-12")).withColumn("version", F.lit("v2"))
    overwrite_partitions(batch, path, ["date", "api_environment"])
    return spark.read.schema("event_id bigint, version string, date string, api_environment string").parquet(path)


@register("full_replace", "SELECT event_id, user_id, 'v2' AS version FROM events")
def q_full_replace(spark, sf_dir):
    """K8: a table flagged for full replacement gets a new version as a whole."""
    from ferrum.sinks.writers import overwrite_all
    ev = T(spark, sf_dir, "events").select("event_id", "user_id")
    path = scratch_path(spark, "full")
    name = _versioned_table(spark, "full")[0]
    overwrite_all(spark, name, ev.withColumn("version", F.lit("v1")), path)
    overwrite_all(spark, name, ev.withColumn("version", F.lit("v2")), path)
    return spark.table(name)


@register("merge_non_null", """
    WITH cur AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
    upd AS (
        SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(0.0 AS DOUBLE) AS c_acctbal,
               CAST(NULL AS VARCHAR) AS c_mktsegment
        FROM customer WHERE c_acctbal < 0
        UNION ALL
        SELECT s_suppkey + 1000000000, s_name, s_acctbal, 'SUPPLIER' FROM supplier)
    SELECT coalesce(cur.c_custkey, upd.c_custkey) AS c_custkey, coalesce(upd.c_name, cur.c_name) AS c_name,
           coalesce(upd.c_acctbal, cur.c_acctbal) AS c_acctbal,
           coalesce(upd.c_mktsegment, cur.c_mktsegment) AS c_mktsegment
    FROM cur FULL OUTER JOIN upd ON cur.c_custkey = upd.c_custkey
""")
def q_merge_non_null(spark, sf_dir):
    """Upsert where only non-NULL update values overwrite."""
    from ferrum.sinks.writers import merge_non_null
    cur = T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    upd = (cur.filter(F.col("c_acctbal") < 0).select(
        "c_custkey", F.lit(None).cast("string").alias("c_name"), F.lit(0.0).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"))
        .unionByName(T(spark, sf_dir, "supplier").select(
            (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
            F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"))))
    return merge_non_null(cur, upd, "c_custkey")


def _route_values_sql():
    from ferrum.sources.routing import EXAMPLE_ROUTES

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return "'" + str(v).replace("'", "''") + "'"
    rows = ",\n".join("(" + ", ".join(lit(v) for v in r) + ")" for r in EXAMPLE_ROUTES)
    return (f"SELECT * FROM (VALUES {rows}) AS t(root, sub, target_table, format, sep, header, quote, "
            "compression, replace_all)")


SQL_STORAGE_KEYS = """
    SELECT event_id,
           CASE event_type WHEN 'view' THEN 'meters' WHEN 'click' THEN 'sensors' WHEN 'purchase' THEN 'feeds'
                WHEN 'error' THEN 'reviews' ELSE 'legacy' END || '/' ||
           CASE event_type WHEN 'view' THEN (CASE WHEN value < 100 THEN 'hourly' ELSE 'daily' END)
                WHEN 'click' THEN (CASE WHEN value < 100 THEN 'raw' ELSE 'debug' END)
                WHEN 'purchase' THEN 'purchases' ELSE 'misc' END || '/' ||
           strftime(ts, '%Y/%m/%d') || '/' || CAST(event_id AS VARCHAR) || '.csv' AS key
    FROM events
"""


def _storage_keys(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    t, small = F.col("event_type"), F.col("value") < 100
    root = (F.when(t == "view", "meters").when(t == "click", "sensors").when(t == "purchase", "feeds")
            .when(t == "error", "reviews").otherwise("legacy"))
    sub = (F.when(t == "view", F.when(small, "hourly").otherwise("daily"))
           .when(t == "click", F.when(small, "raw").otherwise("debug"))
           .when(t == "purchase", "purchases").otherwise("misc"))
    key = F.concat_ws("/", root, sub, F.date_format("ts", "yyyy/MM/dd"), F.concat(F.col("event_id").cast("string"), F.lit(".csv")))
    return e.select("event_id", key.alias("key"))


@register("route_keys", _sql("""
    WITH k AS {k}, r AS {r}
    SELECT k.event_id, k.key, split_part(k.key, '/', 1) AS root, split_part(k.key, '/', 2) AS sub_key,
           CASE WHEN r.sub = '*' THEN split_part(k.key, '/', 2) ELSE r.target_table END AS target_table,
           r.format, r.sep, r.header, r.quote, r.compression, r.replace_all,
           CASE WHEN r.root IS NULL THEN 'unrouted' ELSE 'routed' END AS status
    FROM k LEFT JOIN r ON split_part(k.key, '/', 1) = r.root
         AND (r.sub IS NULL OR r.sub = '*' OR r.sub = split_part(k.key, '/', 2))
""", k=SQL_STORAGE_KEYS, r=_route_values_sql()))
def q_route_keys(spark, sf_dir):
    """S5 S5a-e S6 F15: storage keys resolved to target tables and reader options."""
    from ferrum.sources.routing import resolve_routes, route_table
    return resolve_routes(_storage_keys(spark, sf_dir), route_table(spark))


SQL_LOADED = """
    SELECT event_id, event_type, value, CAST(ts AS DATE) AS day,
           CASE WHEN event_type = 'view' THEN 'meter_hourly' WHEN event_type = 'click' THEN 'sensor_raw'
                WHEN event_type = 'purchase' THEN 'purchases' WHEN event_type = 'error' THEN 'reviews'
                WHEN value < 100 THEN 'stations' WHEN value < 200 THEN 'vendor_list'
                WHEN value < 300 THEN 'catalog_items' END AS target_table
    FROM events
"""


def _load_all(spark, sf_dir):
    """Events landed under dated route prefixes in five formats, and loaded: (report, tables, unrouted)."""
    import uuid as _uuid

    from ferrum.sources.routing import landed_keys, load_into_tables, load_routes, route_table, unrouted
    base = scratch_path(spark, "landing")
    e = T(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.concat(F.col("event_type"), F.lit(", "), F.lit('"q"')).alias("note"),
        "event_type", "value", F.date_format("ts", "yyyy/MM/dd").alias("day"))
    t, v = F.col("event_type"), F.col("value")
    for prefix, cond, sep, quote, gz in (
            ("meters/hourly", t == "view", ",", "", False), ("sensors/raw", t == "click", ",", "", False),
            ("feeds/purchases", t == "purchase", ",", "", False), ("reviews", t == "error", ",", '"', False),
            ("stations", (t == "signup") & (v < 100), ",", "", True), ("vendors", (t == "signup") & (v >= 100) & (v < 200), "|", "", True),
            ("legacy/misc", (t == "signup") & (v >= 300), ",", "", False)):
        # a plain route keeps quotes as data and its texts hold no separator; the quoted one holds both
        rows = e.filter(cond).withColumn("note", F.col("note") if quote else F.regexp_replace("note", ",", ""))
        w = rows.drop("event_type", "value").withColumn("landing", F.col("day")).drop("day").write.partitionBy("landing").option(
            "header", True).option("sep", sep).option("quote", quote).option("escape", quote)
        (w.option("compression", "gzip") if gz else w).csv(f"{base}/{prefix}")
    e.filter((t == "signup") & (v >= 200) & (v < 300)).select("event_id", "note").write.parquet(f"{base}/catalog")
    db = f"loads_{_uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}-db'")
    report = load_into_tables(spark, load_routes(spark, base, route_table(spark)), db, f"{base}-tables")
    return report, db, unrouted(landed_keys(spark, base), route_table(spark))


@register("load_report", _sql("""
    SELECT coalesce(target_table, 'legacy/misc') AS target_table,
           CASE WHEN target_table IS NULL THEN 'none' WHEN event_type = 'signup' AND target_table <> 'x' THEN 'replace_all' ELSE 'append' END AS action,
           CASE WHEN target_table IS NULL THEN 'unrouted' ELSE 'loaded' END AS status,
           CASE WHEN target_table IS NULL THEN NULL ELSE count(*) END AS n_rows
    FROM {l} l GROUP BY target_table, event_type
""", l=SQL_LOADED))
def q_load_report(spark, sf_dir):
    """K9 K8 S5 S5a-e S6: files landed as root[/sub]/<day>/file in five formats; each route is read
    with its own options and loaded into its table (replace-all or append), rows counted during the
    write. Keys without a route are reported."""
    report, _, rest = _load_all(spark, sf_dir)
    return report.select("target_table", "action", "status", "n_rows").unionByName(rest.select(
        F.col("prefix").alias("target_table"), F.lit("none").alias("action"), F.lit("unrouted").alias("status"),
        F.lit(None).cast("long").alias("n_rows")))


@register("load_rows", _sql("""
    SELECT target_table, CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN target_table IN ('reviews', 'catalog_items') THEN event_type || ', "q"' ELSE event_type || ' "q"' END AS note
    FROM {l} l WHERE target_table IS NOT NULL
""", l=SQL_LOADED))
def q_load_rows(spark, sf_dir):
    """S5 S5a-e K8: the rows of every loaded table; quotes and a separator inside a quoted value survive."""
    report, db, _ = _load_all(spark, sf_dir)
    out = None
    for r in report.collect():  # one row per target table
        rows = spark.table(f"{db}.{r['target_table']}").select(F.lit(r["target_table"]).alias("target_table"), "event_id", "note")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("file_selection", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
           value, strftime(ts, '%Y%m%d') || CASE WHEN value < 100 THEN '_events' ELSE '_late' END AS filename
    FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'
""")
def q_file_selection(spark, sf_dir):
    """Of a folder of daily drops, only yesterday's non-empty
    ``YYYYMMDD_*.csv`` files are read."""
    from ferrum.sources.files import select_input_files
    e = T(spark, sf_dir, "events")
    root = scratch_path(spark, "drops")
    day = F.date_format("ts", "yyyyMMdd")
    small = F.col("value") < 100
    # two drops of each day with their columns in another order, and files of other columns beside them
    for cols, name, cond in ((["event_id", "user_id", "value"], "_events.csv", small), (["value", "user_id", "event_id"], "_late.csv", ~small)):
        (e.filter(cond).withColumn("landing_file", F.concat(day, F.lit(name))).select(*cols, "landing_file")
           .write.mode("append").partitionBy("landing_file").option("header", True).csv(root))
    (e.groupBy("event_type").count().withColumn("landing_file", F.lit("19990101_types.csv"))
       .write.mode("append").partitionBy("landing_file").option("header", True).csv(root))
    got = select_input_files(spark, root, "2024-01-30", name_from="parent")
    return got.select("event_id", "user_id", F.col("value").try_cast("double").alias("value"), "filename")


@register("landing_dates", """
    SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
           count(*) AS n_rows,
           'events/' || strftime(ts, '%Y/%m/%d') || '/events.json' AS key
    FROM events GROUP BY 1, 2, 3, 5
""")
def q_landing_dates(spark, sf_dir):
    """K5: date-path layout root/YYYY/MM/DD, written partitioned and read back."""
    from ferrum.sinks.writers import date_layout_key, with_date_parts
    e = T(spark, sf_dir, "events")
    path = scratch_path(spark, "by-date")
    with_date_parts(e.select("event_id", "ts"), "ts").write.partitionBy("year", "month", "day").parquet(path)
    back = spark.read.schema("event_id bigint, ts timestamp_ntz, year string, month string, day string").parquet(path)
    g = back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))
    day = F.to_date(F.concat_ws("-", "year", "month", "day"))
    return g.withColumn("key", date_layout_key("events", F.lit("events.json"), day))


@register("csv_roundtrip", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
""")
def q_csv_roundtrip(spark, sf_dir):
    """Overwrite a CSV with header, read it back with every column as text."""
    from ferrum.sinks.writers import write_csv
    from ferrum.sources.files import read_csv_strings
    path = scratch_path(spark, "csv")
    write_csv(T(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path)
    back = read_csv_strings(spark, path)
    return back.select("c_custkey", "c_name", F.col("c_acctbal").try_cast("double").alias("c_acctbal"),
                       "c_mktsegment")


# --------------------------------------------------------------------------------------
# 7. Column shapes, scalar functions, rejects, day intervals, DDL

ALIGN_FIXED = ["id", "logged_at", "region", "cadence", "view_level", "click_level", "error_level",
               "bought", "paired", "dealer", "installed_on", "platform"]


@register("align_columns", """
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "logged_at",
           CASE WHEN event_type IN ('view', 'purchase') THEN 'DE' END AS region,
           CASE WHEN event_type = 'click' THEN 'daily' END AS cadence,
           CASE WHEN event_type = 'view' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS view_level,
           '' AS click_level, '' AS error_level,
           CASE WHEN event_type = 'purchase' THEN 'true' END AS bought,
           '' AS paired, '' AS dealer, '' AS installed_on,
           CASE WHEN event_type = 'click' THEN 'android' END AS platform,
           CASE WHEN event_type = 'error' THEN 'E' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS error_code
    FROM events
""")
def q_align_columns(spark, sf_dir):
    """Ragged JSON records (schema inferred on read) aligned to the fixed
    column list; absent columns filled with '', unknown ones appended."""
    from ferrum.operators.columns import align_columns
    from ferrum.sources.files import read_json
    e = T(spark, sf_dir, "events")
    t = F.col("event_type")
    rec = F.struct(
        F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("logged_at"),
        F.when(t.isin("view", "purchase"), "DE").alias("region"),
        F.when(t == "click", "daily").alias("cadence"),
        F.when(t == "view", F.floor("value").cast("string")).alias("view_level"),
        F.when(t == "purchase", "true").alias("bought"),
        F.when(t == "click", "android").alias("platform"),
        F.when(t == "error", F.concat(F.lit("E"), F.floor("value").cast("string"))).alias("error_code"))
    path = scratch_path(spark, "records")
    e.select(F.to_json(rec).alias("value")).write.text(path)
    return align_columns(read_json(spark, path), ALIGN_FIXED)


@register("status_normalise", """
    SELECT event_id,
           coalesce(TRY_CAST(CASE WHEN value < 100 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS INTEGER), 0) AS status_reg,
           coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS status_dp,
           coalesce(TRY_CAST(CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN 'yes' ELSE '1' END AS INTEGER), 0) AS status_app,
           coalesce(TRY_CAST(CASE WHEN value > 200 THEN '0' END AS INTEGER), 0) AS app_installed
    FROM events
""")
def q_status_normalise(spark, sf_dir):
    """P5: NULL / empty / non-numeric status text -> 0, numbers -> int."""
    from ferrum.operators.columns import normalize_status
    e = T(spark, sf_dir, "events")
    t = F.col("event_type")
    raw = e.select(
        "event_id",
        F.when(F.col("value") < 100, F.floor("value").cast("string")).alias("status_reg"),
        F.get_json_object("props", "$.k").alias("status_dp"),
        F.when(t == "error", "").when(t == "signup", "yes").otherwise("1").alias("status_app"),
        F.when(F.col("value") > 200, "0").alias("app_installed"))
    return normalize_status(raw, ["status_reg", "status_dp", "status_app", "app_installed"])


@register("snake_case_values", r"""
    WITH r AS (
        SELECT event_id,
               upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || 'Event'
                 || upper(substr(event_type, 1, 2)) || 'Id' || CAST(user_id AS VARCHAR) || 'Value' AS raw
        FROM events)
    SELECT event_id, raw,
           lower(regexp_replace(regexp_replace(raw, '(.)([A-Z][a-z]+)', '\1_\2', 'g'),
                                '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake
    FROM r
""")
def q_snake_case_values(spark, sf_dir):
    """camelCase -> snake_case on values (two regex passes + lower)."""
    from ferrum.functions.text import snake_case
    e = T(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    raw = F.concat(F.initcap("event_type"), F.lit("Event"), F.upper(F.substring("event_type", 1, 2)),
                   F.lit("Id"), F.col("user_id").cast("string"), F.lit("Value"))
    return e.select("event_id", raw.alias("raw")).withColumn("snake", snake_case("raw"))


SCALAR_AS_OF = "2001-08-02 06:30:15.123456"


@register("scalar_dates_text", r"""
    SELECT o_orderkey,
           CAST(epoch(o_orderdate) AS BIGINT) AS epoch_s,
           '2001-08-02' AS as_of_day,
           '2001-08-02 06:30:15' AS load_ts,
           strftime(CAST(o_orderdate AS DATE) - INTERVAL 3 DAY, '%Y%m%d') AS day_minus_3,
           strftime(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d'), '%d.%m.%Y') AS dotted,
           CAST(date_diff('day', o_orderdate, TIMESTAMP '2001-08-02 06:30:15.123456') AS INTEGER) AS age_days,
           CAST(o_orderdate AS DATE) = DATE '2001-08-02' AS same_day,
           strftime(o_orderdate + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS plus_15_min,
           strftime(strptime(strftime(o_orderdate, '%Y%j'), '%Y%j'), '%Y-%m-%d') AS from_day_of_year,
           regexp_full_match(strftime(o_orderdate, '%Y%m%d') || '_' || o_orderpriority || '.csv',
                             '\d{8}_1-URGENT\.csv') AS urgent_file,
           string_split(o_orderpriority, '-')[-1] AS priority_word,
           'contracts/' || o_orderstatus || '/' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS object_key,
           url_decode(replace(replace(o_orderpriority, '-', '%2F') || '+' || o_orderstatus, '+', ' ')) AS decoded,
           lower(o_orderpriority) AS lower_p, upper(o_orderpriority) AS upper_p,
           replace('''' || o_orderstatus || '''', '''', '') AS unquoted,
           CAST(CAST(ROUND(o_totalprice / 7, 4) AS DECIMAL(18,4)) AS DOUBLE) AS price_dec,
           'DE' AS country
    FROM orders
""")
def q_scalar_dates_text(spark, sf_dir):
    """F2 F4-F6 F9 F11 F12 F15-F17 F19 F22 in one projection (no shuffle)."""
    from ferrum.functions import dates as D
    from ferrum.functions import text as X
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    as_of = D.as_of_literal(SCALAR_AS_OF)
    file_name = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.col("o_orderpriority"), F.lit(".csv"))
    return o.select(
        "o_orderkey",
        D.epoch_seconds(F.col("o_orderdate")).alias("epoch_s"),
        F.date_format(F.to_date(as_of), "yyyy-MM-dd").alias("as_of_day"),
        ts_text(F.date_trunc("second", as_of)).alias("load_ts"),
        D.days_before(F.col("o_orderdate"), 3, "yyyyMMdd").alias("day_minus_3"),
        D.reformat_compact_day(F.date_format("o_orderdate", "yyyyMMdd")).alias("dotted"),
        D.day_age(F.col("o_orderdate"), as_of).alias("age_days"),
        D.same_day(F.col("o_orderdate"), as_of).alias("same_day"),
        ts_text(F.col("o_orderdate") + F.expr("INTERVAL 15 MINUTES")).alias("plus_15_min"),
        F.date_format(D.parse_day_of_year(F.date_format("o_orderdate", "yyyyDDD")), "yyyy-MM-dd").alias("from_day_of_year"),
        file_name.rlike(X.anchored("\\d{8}_1-URGENT\\.csv")).alias("urgent_file"),
        F.element_at(F.split("o_orderpriority", "-"), -1).alias("priority_word"),
        F.concat_ws("/", F.lit("contracts"), "o_orderstatus",
                    F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv"))).alias("object_key"),
        X.url_decode_plus(F.concat(F.regexp_replace("o_orderpriority", "-", "%2F"), F.lit("+"),
                                   F.col("o_orderstatus"))).alias("decoded"),
        F.lower("o_orderpriority").alias("lower_p"), F.upper("o_orderpriority").alias("upper_p"),
        F.regexp_replace(F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("'")), "'", "").alias("unquoted"),
        D.to_decimal4(F.col("o_totalprice") / 7).cast("double").alias("price_dec"),
        F.lit("DE").alias("country"))


@register("reject_report", """
    SELECT l_orderkey, l_linenumber, l_partkey, 'returned item ' || CAST(l_linenumber AS VARCHAR) AS error_message
    FROM lineitem WHERE l_returnflag = 'R'
""")
def q_reject_report(spark, sf_dir):
    """Ordinals quoted in per-batch error texts matched back to the records."""
    from ferrum.operators.rejects import rejected_records
    li = T(spark, sf_dir, "lineitem")
    # a batch is one order, the ordinal a record's place in it (from its columns, so every scan agrees)
    place = Window.partitionBy("l_orderkey").orderBy(*[c for c in li.columns if c != "l_orderkey"])
    records = li.withColumns({"batch": F.col("l_orderkey"), "ordinal": F.row_number().over(place)}).select(
        "batch", "ordinal", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    line = F.when(F.col("l_returnflag") == "R", F.concat(
        F.lit("Description: /"), F.col("ordinal").cast("string"), F.lit("/ returned item "),
        F.col("l_linenumber").cast("string")))
    responses = (records.groupBy("batch")
                 .agg(F.concat_ws("\n", F.collect_list(line)).alias("error_text"))
                 .filter(F.length("error_text") > 0))
    out = rejected_records(records, responses, ["batch"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "error_message")


@register("date_interval", """
    SELECT l.l_orderkey, l.l_linenumber,
           CAST(CASE WHEN CAST(o.o_orderdate AS DATE) <= CAST(l.l_shipdate AS DATE)
                THEN date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) + 1 ELSE 0 END AS INTEGER) AS n_days,
           CAST(CASE WHEN CAST(l.l_shipdate AS DATE) <= CAST(o.o_orderdate AS DATE)
                THEN date_diff('day', CAST(l.l_shipdate AS DATE), CAST(o.o_orderdate AS DATE)) + 1 ELSE 0 END AS INTEGER) AS n_days_reversed,
           CAST(abs(date_diff('day', CAST(l.l_shipdate AS DATE), CAST(o.o_orderdate AS DATE))) + 1 AS INTEGER) AS n_days_swapped,
           strftime(least(CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)), '%Y-%m-%d') AS first_day,
           CAST(greatest(l.l_linenumber, 2) - 1 AS INTEGER) AS n_trailing,
           strftime(CAST(l.l_shipdate AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS last_trailing
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def q_date_interval(spark, sf_dir):
    """Inclusive day ranges (empty when reversed / swapped) and trailing days."""
    from ferrum.functions.dates import inclusive_days, trailing_days
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    fwd = inclusive_days("o_orderdate", "l_shipdate", "empty")
    swapped = inclusive_days("l_shipdate", "o_orderdate", "swap")
    trailing = trailing_days(F.col("l_shipdate"), F.col("l_linenumber"))
    return j.select(
        "l_orderkey", "l_linenumber",
        F.size(fwd).alias("n_days"),
        F.size(inclusive_days("l_shipdate", "o_orderdate", "empty")).alias("n_days_reversed"),
        F.size(swapped).alias("n_days_swapped"),
        F.date_format(F.element_at(swapped, 1), "yyyy-MM-dd").alias("first_day"),
        F.size(trailing).alias("n_trailing"),
        F.date_format(F.element_at(trailing, -1), "yyyy-MM-dd").alias("last_trailing"))


@register("day_pull_status", """
    WITH w AS (SELECT CAST(generate_series AS DATE) AS day
               FROM generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)),
    d AS (SELECT CAST(ts AS DATE) AS day,
                 count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase' AND value > 300) AS n_clients
          FROM events GROUP BY 1)
    SELECT strftime(w.day, '%Y-%m-%d') AS day, d.n_clients,
           CASE WHEN d.n_clients IS NULL THEN 'error' WHEN d.n_clients = 0 THEN 'empty' ELSE 'loaded' END AS status,
           CASE WHEN d.n_clients > 0 THEN 'prod' END AS api_environment
    FROM w LEFT JOIN d ON w.day = d.day
""")
def q_day_pull_status(spark, sf_dir):
    """Wanted days vs landed day documents (loaded / empty / error);
    the pluggable processor runs on loaded days only."""
    from ferrum.sources.days import day_pull_status, wanted_days
    e = T(spark, sf_dir, "events")
    docs = e.groupBy(F.to_date("ts").alias("day")).agg(
        F.countDistinct(F.when((F.col("event_type") == "purchase") & (F.col("value") > 300),
                               F.col("user_id"))).alias("n_clients"))
    wanted = wanted_days(spark, "2023-12-30", "2024-02-02")
    out = day_pull_status(wanted, docs, processor=lambda df: df.withColumn("api_environment", F.lit("prod")))
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_clients", "status", "api_environment")


@register("ddl_users", """
    SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           '+49-' || CAST(c_custkey AS VARCHAR) AS tel
    FROM customer
""")
def q_ddl_users(spark, sf_dir):
    """Create the users table from its DDL, load it, check the key is unique."""
    from ferrum.sinks.tables import create_users_table, duplicate_keys
    import uuid as _uuid
    name = f"users_{_uuid.uuid4().hex[:8]}"
    create_users_table(spark, name, scratch_path(spark, "users"))
    c = T(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"),
                    F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
                    F.concat(F.lit("+49-"), F.col("c_custkey").cast("string")).alias("tel"))
    rows.write.insertInto(name)
    dups = duplicate_keys(spark.table(name), ["id"])
    if not dups.isEmpty():
        raise ValueError(f"duplicate primary keys in {name}")
    return spark.table(name)


# --------------------------------------------------------------------------------------
# 8. Streaming

@register("stream_landing", """
    SELECT CASE WHEN event_type = 'signup' THEN 'unknown' ELSE upper(event_type) END AS msg_type,
           strftime(ts, '%Y-%m-%d') AS landing_date, 'DE' AS country, count(*) AS n_messages
    FROM events GROUP BY 1, 2
""")
def q_stream_landing(spark, sf_dir):
    """Queued messages landed by a checkpointed file-sink stream
    (availableNow, bounded files per trigger), read back and counted."""
    from ferrum.plans.standins import queue_messages
    from ferrum.streaming.landing import land_messages, read_landed
    root = scratch_path(spark, "queue")
    queue_messages(T(spark, sf_dir, "events")).select("received_at", "body").write.json(f"{root}/in")
    q = land_messages(spark, f"{root}/in", f"{root}/landed", f"{root}/checkpoint", max_files_per_trigger=4)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    landed = read_landed(spark, f"{root}/landed")
    return landed.groupBy("msg_type", "landing_date", "country").agg(F.count(F.lit(1)).alias("n_messages"))


ALARM_DELAY = "1 hour"


@register("kpi_alarm_stream", """
    WITH w AS (
        SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS ws, event_type, min(value) AS stat
        FROM events GROUP BY 1, 2)
    SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(ws + INTERVAL 15 MINUTES, '%Y-%m-%d %H:%M:%S') AS window_end,
           event_type, stat, CASE WHEN stat <= 5 THEN 'ALARM' ELSE 'OK' END AS state
    FROM w
""")
def q_kpi_alarm_stream(spark, sf_dir):
    """The alarm as a watermarked stream (NTZ cast to timestamp, 1 h delay); append mode
    emits the windows the watermark has closed, and the ended input's open windows follow."""
    from ferrum.streaming.alarm import open_window_alarms, start_alarm
    root = scratch_path(spark, "alarm")
    q = start_alarm(spark, sf_dir, "ts timestamp_ntz, event_type string, value double", f"{root}/out",
                    f"{root}/checkpoint", ts="ts", value="value", keys=["event_type"], glob="events.parquet",
                    period_seconds=900, threshold=5.0, delay=ALARM_DELAY)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    tail = open_window_alarms(T(spark, sf_dir, "events").select("ts", "event_type", "value"), "ts", "value",
                              keys=["event_type"], period_seconds=900, threshold=5.0, delay=ALARM_DELAY)
    out = spark.read.parquet(f"{root}/out").unionByName(tail)
    return out.select(ts_text("window_start").alias("window_start"), ts_text("window_end").alias("window_end"),
                      "event_type", "stat", "state")


# --------------------------------------------------------------------------------------
# 9. Query scans and end-to-end jobs

@register("consent_sql", _sql("""
    SELECT CAST(c.c_custkey AS VARCHAR) AS vehicle_vin, c.c_name AS customer_name, n.n_name AS nation,
           r.r_name AS region
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE n.n_name LIKE '%1%' AND c.c_mktsegment = 'BUILDING' AND r.r_name = 'ASIA'
"""))
def q_consent_sql(spark, sf_dir):
    """The consent query as SQL text over registered views, columns named by the caller."""
    import uuid as _uuid

    from ferrum.sources.sql import query_table
    sfx = _uuid.uuid4().hex[:8]
    views = {f"customer_{sfx}": T(spark, sf_dir, "customer"), f"nation_{sfx}": T(spark, sf_dir, "nation"),
             f"region_{sfx}": T(spark, sf_dir, "region")}
    sql = f"""
        SELECT CAST(c.c_custkey AS STRING), c.c_name, n.n_name, r.r_name
        FROM customer_{sfx} c
        JOIN nation_{sfx} n ON c.c_nationkey = n.n_nationkey
        JOIN region_{sfx} r ON n.n_regionkey = r.r_regionkey
        WHERE n.n_name LIKE '%1%' AND c.c_mktsegment = 'BUILDING' AND r.r_name = 'ASIA'
    """
    return query_table(spark, sql, ["vehicle_vin", "customer_name", "nation", "region"], views)


@register("contract_load", _sql("""
    SELECT c.vehicleIdentificationNumber AS vehicle_identification_number,
           c.subscriptionVehicleCategory AS subscription_vehicle_category, c.product,
           strftime(TRY_CAST(c.inceptionDate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS inception_date,
           strftime(TRY_CAST(c.contractEndDate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS contract_end_date,
           TRY_CAST(c.duration AS DOUBLE) AS duration, '2001-08-02 06:30:15' AS event_timestamp,
           replace(c.filename, '.csv', '') AS filename
    FROM {raw} c JOIN {con} k ON c.vehicleIdentificationNumber = k.vehicle_vin
""", raw=SQL_RAW_CONTRACTS, con=SQL_CONSENT_3WAY))
def q_contract_load(spark, sf_dir):
    """Contract drops (CSV per file) through
    consent, typing, per-file output and table appends; the stored contracts."""
    contracts = _contract_job(spark, sf_dir)[0]
    return contracts.withColumns({c: ts_text(c) for c in ("inception_date", "contract_end_date", "event_timestamp")})


def _contract_job(spark, sf_dir, seeded=False):
    """One run of the contract job over every drop: (contract table, KPI table, output root)."""
    import uuid as _uuid

    from ferrum.operators.contracts import typed_contracts
    from ferrum.plans.jobs import contract_load, read_contract_drops
    from ferrum.sinks.writers import append_to_table
    root = scratch_path(spark, "contracts-job")
    raw = _raw_contracts(spark, sf_dir).drop("contract_id", "event_timestamp")
    raw.withColumnRenamed("filename", "landing_file").write.partitionBy("landing_file").option("header", True).csv(f"{root}/drops")
    drops = read_contract_drops(spark, f"{root}/drops", name_from="parent")
    sfx = _uuid.uuid4().hex[:8]
    if seeded:
        old = typed_contracts(raw.filter(F.col("product") == "F"), "2001-07-01 00:00:00")
        append_to_table(old, f"contract_staging_{sfx}", f"{root}/tables/contract_staging_{sfx}",
                        bucket_by=(int(spark.conf.get("spark.sql.shuffle.partitions")), ["vehicle_identification_number"]))
    contracts, kpis = contract_load(spark, drops, _consent_3way(spark, sf_dir), CONTRACTS_AS_OF, out_root=root,
                                    contracts_table=f"contract_staging_{sfx}", kpi_table_name=f"kpi_{sfx}")
    return contracts, kpis, root


@register("contract_job_kpis", _sql("""
    WITH k AS {k}, raw AS {raw}, con AS {con},
    seeds AS (SELECT vehicleIdentificationNumber AS vin FROM raw WHERE product = 'F'),
    loaded AS (SELECT r.vehicleIdentificationNumber AS vin FROM raw r JOIN con ON r.vehicleIdentificationNumber = con.vehicle_vin),
    longf AS (
        SELECT 'file_rows' AS kpi_name, n_contracts AS v, replace(filename, '.csv', '') AS context FROM k
        UNION ALL SELECT 'file_vehicles', n_unique_vins, replace(filename, '.csv', '') FROM k
        UNION ALL SELECT 'consenting_vehicles', n_consent_total, replace(filename, '.csv', '') FROM k
        UNION ALL SELECT 'file_vehicles_consenting', n_vins_with_consent, replace(filename, '.csv', '') FROM k
        UNION ALL SELECT 'file_vehicles_refused', n_vins_without_consent, replace(filename, '.csv', '') FROM k
        UNION ALL SELECT 'stored_rows_without_consent', (SELECT count(*) FROM seeds WHERE vin NOT IN (SELECT vehicle_vin FROM con)), 'n/a'
        UNION ALL SELECT 'vehicles_first_seen', (SELECT count(DISTINCT vin) FROM loaded WHERE vin NOT IN (SELECT vin FROM seeds)), 'n/a'
        UNION ALL SELECT 'vehicles_seen_before', (SELECT count(DISTINCT vin) FROM loaded WHERE vin IN (SELECT vin FROM seeds)), 'n/a')
    SELECT kpi_name, CAST(v AS DOUBLE) AS kpi_value, context FROM longf
""", k=SQL_FILE_KPIS, con=SQL_CONSENT_3WAY, raw=SQL_RAW_CONTRACTS))
def q_contract_job_kpis(spark, sf_dir):
    """The KPI table after the contract job ran into a table that holds the finished orders'
    contracts already: five metrics per file and three over the stored table."""
    return _contract_job(spark, sf_dir, seeded=True)[1].select("kpi_name", F.col("kpi_value").cast("double").alias("kpi_value"), "context")


@register("contract_job_files", _sql("""
    SELECT replace(c.filename, '.csv', '') AS filename, c.vehicleIdentificationNumber AS vehicle_identification_number, count(*) AS n
    FROM {raw} c JOIN {con} k ON c.vehicleIdentificationNumber = k.vehicle_vin GROUP BY 1, 2
""", raw=SQL_RAW_CONTRACTS, con=SQL_CONSENT_3WAY))
def q_contract_job_files(spark, sf_dir):
    """K3: the job's per-source-file folders read back."""
    root = _contract_job(spark, sf_dir)[2]
    back = spark.read.option("basePath", f"{root}/processed_data").parquet(f"{root}/processed_data")
    return back.groupBy(F.col("filename").cast("string").alias("filename"), "vehicle_identification_number").agg(F.count(F.lit(1)).alias("n"))


@register("incremental_load", f"""
    {LEDGER_WITH},
    C AS (SELECT kpi, from_id, retries - 1 AS retries FROM A WHERE action = 'retry_stale'),
    U AS (
        SELECT L.kpi, L.from_id, L.to_id,
               CASE WHEN C.kpi IS NOT NULL AND L.status = 'RUNNING' AND L.finished_at IS NULL THEN 'FAILED' ELSE L.status END AS status,
               L.created_at,
               CASE WHEN C.kpi IS NOT NULL AND L.status = 'RUNNING' AND L.finished_at IS NULL THEN {LEDGER_TS} ELSE L.finished_at END AS finished_at,
               L.retries,
               CASE WHEN C.kpi IS NOT NULL AND L.status = 'RUNNING' AND L.finished_at IS NULL THEN 'STALE JOB' ELSE L.details END AS details
        FROM L LEFT JOIN C ON L.kpi = C.kpi AND L.from_id = C.from_id AND L.retries = C.retries
        UNION ALL
        SELECT kpi, from_id, CAST(NULL AS BIGINT), 'RUNNING', {LEDGER_TS}, CAST(NULL AS TIMESTAMP), retries, CAST(NULL AS VARCHAR)
        FROM A WHERE action <> 'wait'),
    S AS ({SQL_SCAN}),
    G AS (SELECT kpi, job_from_id, count(*) AS n_rows, max(id) AS max_id FROM S GROUP BY kpi, job_from_id),
    V AS (
        SELECT A.kpi, A.from_id, A.retries,
               CASE WHEN coalesce(G.n_rows, 0) = 0 THEN 'empty'
                    WHEN G.max_id = 0 OR G.max_id < A.from_id THEN 'invalid'
                    WHEN G.max_id - A.from_id < 100 THEN 'too_small' ELSE 'load' END AS outcome,
               G.max_id
        FROM A LEFT JOIN G ON A.kpi = G.kpi AND A.from_id = G.job_from_id
        WHERE A.from_id IS NOT NULL),
    X AS (
        SELECT U.*, V.kpi IS NOT NULL AND U.status = 'RUNNING' AND U.finished_at IS NULL AS hit, V.outcome, V.max_id
        FROM U LEFT JOIN V ON U.kpi = V.kpi AND U.from_id = V.from_id AND U.retries = V.retries)
    SELECT kpi, from_id,
           CASE WHEN hit AND outcome = 'load' THEN max_id ELSE to_id END AS to_id,
           CASE WHEN hit THEN (CASE WHEN outcome = 'load' THEN 'SUCCESS' ELSE 'FAILED' END) ELSE status END AS status,
           strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
           strftime(CASE WHEN hit THEN {LEDGER_TS} ELSE finished_at END, '%Y-%m-%d %H:%M:%S') AS finished_at,
           retries,
           CASE WHEN hit THEN outcome ELSE details END AS details
    FROM X
""")
def q_incremental_load(spark, sf_dir):
    """One loader run for every KPI; the ledger after the run
    (the target table gets a new version first)."""
    return _ledger_text(_loader_run(spark, sf_dir)[0])


@register("incremental_target", f"""
    {LEDGER_WITH}, S AS ({SQL_SCAN}),
    G AS (SELECT kpi, job_from_id, max(id) AS max_id FROM S GROUP BY kpi, job_from_id)
    SELECT S.kpi, S.id, S.event_type, S.value FROM S JOIN G ON S.kpi = G.kpi AND S.job_from_id = G.job_from_id
    WHERE G.max_id <> 0 AND G.max_id - S.job_from_id >= 100
""")
def q_incremental_target(spark, sf_dir):
    """The rows of the target table after the loader run."""
    return _loader_run(spark, sf_dir)[1].select("kpi", "id", "event_type", "value")


def _loader_run(spark, sf_dir):
    from ferrum.plans.jobs import incremental_load
    ledger, registry = _ledger(spark, sf_dir)
    records = _records(spark, sf_dir)
    name, root = _versioned_table(spark, "loaded_records")
    from ferrum.sinks.writers import commit_version
    commit_version(spark, name, spark.createDataFrame([], records.schema), root)
    return incremental_load(spark, registry, ledger, records, name, LEDGER_AS_OF, version_root=root,
                            stale_after=LEDGER_STALE_AFTER, ledger_table=f"{name}_ledger")


from ferrum.plans import catalogue_state  # noqa: E402, F401 - registers its queries here
