"""End-to-end jobs composed from the operators (no logic of their own).

* ``contract_load``: daily contract drops -> consent check -> typed output per
  source file + contract table + KPI table; ``contract_day``: the same for one day, with its alerts.
* ``incremental_load`` (one loader) and ``run_loader`` (several at once): ledger decision for every KPI -> id-range pull ->
  validation -> idempotent range replace of the target -> ledger update.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrum.operators import consent as C
from ferrum.operators import ledger as L
from ferrum.operators.contracts import RAW_CONTRACT_COLUMNS, typed_contracts
from ferrum.operators.kpi import FILE_METRIC_NAMES, STORED_METRIC_NAMES, kpi_table, merge_metric_sets, window_alarm
from ferrum.session import scratch_path
from ferrum.sinks.blocks import DEFAULT_BLOCK_SIZE, replace_ranges_in_blocks
from ferrum.sinks.versions import CommitConflict, VersionedTable
from ferrum.sinks.writers import append_to_table, commit_version, replace_keyed_ranges, write_per_source_file
from ferrum.sources.files import list_files, require_columns, select_input_files


def read_contract_drops(spark: SparkSession, folder: str, day: str | None = None,
                        name_from: str = "file") -> DataFrame:
    """All-string contract rows of one day's drops (``day``) or of every drop."""
    return select_input_files(spark, folder, day, name_from=name_from)


def contract_load(spark: SparkSession, drops: DataFrame, consent: DataFrame, as_of: str, *,
                  out_root: str, contracts_table: str, kpi_table_name: str) -> tuple[DataFrame, DataFrame]:
    """Consent-filter and type the contract rows of ``drops`` and compute per-file KPIs.

    Writes the typed consenting contracts once per source file under
    ``out_root/processed_data``, appends them to the contract table, then measures
    that table (rows without consent, vehicles first seen and seen before on
    ``as_of``'s day) and appends all eight KPIs. Returns ``(contracts_table,
    kpi_table)`` frames; ``contract_day`` also says what to notify.
    """
    # The day's drop rows feed three writes; keep them for the job's duration
    # (memory and disk; lost blocks are recomputed from the files).
    raw = require_columns(drops, RAW_CONTRACT_COLUMNS + ["filename"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kpis = kpi_table(C.file_kpis(raw, consent), FILE_METRIC_NAMES, as_of=as_of, context_col="filename")
        kept = C.filter_by_consent(raw, consent, columns=RAW_CONTRACT_COLUMNS + ["filename"])
        typed = typed_contracts(kept, as_of).persist(StorageLevel.MEMORY_AND_DISK)
        # A re-delivered file replaces its own folder (dynamic overwrite), others stay.
        write_per_source_file(typed, f"{out_root}/processed_data", mode="overwrite")
        # Stored contracts are bucketed by vehicle: every later consent check joins on it.
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        append_to_table(typed, contracts_table, f"{out_root}/tables/{contracts_table}",
                        bucket_by=(buckets, ["vehicle_identification_number"]))
        stored = kpi_table(C.stored_kpis(spark.table(contracts_table), consent, as_of), STORED_METRIC_NAMES, as_of=as_of)
        append_to_table(merge_metric_sets(kpis, stored), kpi_table_name, f"{out_root}/tables/{kpi_table_name}")
        typed.unpersist()
    finally:
        raw.unpersist()
    return spark.table(contracts_table), spark.table(kpi_table_name)


def contract_day(spark: SparkSession, folder: str, day: str, consent: DataFrame, as_of: str, *, out_root: str, contracts_table: str,
                 kpi_table_name: str, alerts_table: str, alarms: dict[str, float], prefix: str = "", name_from: str = "file") -> DataFrame:
    """One day of the contract job: load the day's drops, then say what to notify.

    Without a drop of ``day`` nothing is loaded and one alert says so. Otherwise ``contract_load`` runs and
    every KPI of ``alarms`` ({kpi name: threshold}) whose smallest value in the run's 900 s period is at or below its threshold is
    an alert. Alerts are appended to ``alerts_table``; returns that table.
    """
    missing = missing_drop_alert(spark, folder, day, prefix, name_from).filter("missing").select(
        F.lit("missing drop").alias("subject"), "day", F.date_format("day", "dd.MM.yyyy").alias("name"),
        F.col("n_files").cast("double").alias("value"), F.lit("ALARM").alias("state"))
    alerts = missing
    if missing.isEmpty():
        drops = read_contract_drops(spark, folder, day, name_from)
        contract_load(spark, drops, consent, as_of, out_root=out_root, contracts_table=contracts_table, kpi_table_name=kpi_table_name)
        now = spark.table(kpi_table_name).filter(F.col("kpi_timestamp") == F.to_timestamp(F.lit(as_of)))
        rules = spark.createDataFrame(list(alarms.items()), "name string, threshold double")
        # The distance to the threshold makes one alarm of all KPIs.
        held = now.join(rules, F.col("kpi_name") == F.col("name")).withColumn("over", F.col("kpi_value").cast("double") - F.col("threshold"))
        state = window_alarm(held, "kpi_timestamp", "over", keys=["name", "threshold"], threshold=0.0)
        alerts = state.filter("state = 'ALARM'").select(F.lit("kpi alarm").alias("subject"), F.to_date(F.lit(day)).alias("day"), "name",
                                                        (F.col("stat") + F.col("threshold")).alias("value"), "state")
    append_to_table(alerts, alerts_table, f"{out_root}/tables/{alerts_table}")
    return spark.table(alerts_table)


def missing_drop_alert(spark: SparkSession, folder: str, day: str, prefix: str = "", name_from: str = "file") -> DataFrame:
    """One row (day, n_files, missing): whether ``day``'s contract drops have arrived."""
    n = len(list_files(spark, folder, name_from, pattern=f"{prefix}{day.replace('-', '')}_.*\\.csv"))
    return spark.range(1).select(F.to_date(F.lit(day)).alias("day"), F.lit(n).cast("long").alias("n_files"), F.lit(n == 0).alias("missing"))


def start_jobs(store: VersionedTable, registry: DataFrame, as_of: str, *, stale_after: str = L.DEFAULT_STALE_AFTER,
               initial_from_id: int = 0, tries: int = 20) -> DataFrame:
    """Decide every KPI's next action and commit the RUNNING rows, as one step against other loaders.

    The decision and the rows belong to one version of the ledger. If another run has committed since, the ledger is
    read and decided again: a KPI that the other run has just started is then ``wait``. Returns the
    actions that this run has started (written, so they are not decided anew).
    """
    spark = registry.sparkSession
    for _ in range(tries):
        version, ledger = store.read()
        path = scratch_path(spark, "actions")
        actions = L.next_actions(registry, ledger, as_of, stale_after=stale_after, initial_from_id=initial_from_id)
        actions.write.parquet(path)
        actions = spark.read.schema(actions.schema).parquet(path)
        try:
            store.commit(version, L.apply_actions(ledger, actions, as_of))
            return actions
        except CommitConflict:
            continue
    raise CommitConflict(f"no start after {tries} tries")


def _load_actions(actions: DataFrame, records: DataFrame, target_table: str, *, version_root: str, key: str, id_col: str,
                  batch_size: int, min_ids: int, block_size: int | None, groups: int | None) -> DataFrame:
    """Pull, validate and replace the ranges of ``actions`` in the target; the outcomes, written."""
    spark = records.sparkSession
    scanned = L.scan_ranges(records, actions, key=key, id_col=id_col, batch_size=batch_size).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        checked = L.validate_ranges(actions, scanned, id_col=id_col, min_ids=min_ids)
        path = scratch_path(spark, "outcomes")
        checked = checked.withColumn("details", F.col("outcome"))
        checked.write.parquet(path)
        checked = spark.read.schema(checked.schema).parquet(path)
        ok = checked.filter(F.col("success"))
        new_rows = (scanned.join(ok.select(F.col("kpi").alias("__k"), F.col("from_id").alias("__f")),
                                 (F.col(key) == F.col("__k")) & (F.col("job_from_id") == F.col("__f")), "left_semi")
                    .select(*records.columns))
        ranges = ok.select(F.col("kpi").alias(key), "from_id", "to_id")
        if block_size:
            replace_ranges_in_blocks(spark, target_table, new_rows, ranges, version_root, key=key, id_col=id_col, block_size=block_size, groups=groups)
        else:
            commit_version(spark, target_table, replace_keyed_ranges(spark.table(target_table), new_rows, ranges, key=key, id_col=id_col), version_root)
    finally:
        scanned.unpersist()
    return checked.select("kpi", "from_id", "retries", "success", "to_id", "details")


def run_loader(store: VersionedTable, registry: DataFrame, records: DataFrame, target_table: str, as_of: str, *, version_root: str,
               key: str = "kpi", id_col: str = "id", stale_after: str = L.DEFAULT_STALE_AFTER, batch_size: int = L.BATCH_SIZE,
               min_ids: int = L.MIN_IDS, initial_from_id: int = 0, block_size: int = DEFAULT_BLOCK_SIZE, groups: int | None = None) -> DataFrame:
    """One run of the incremental loader beside others: jobs are started in a committed ledger version, their ranges
    loaded, then closed in another. Returns the newest ledger.

    Loaders that run at once never start the same range, nor two ranges of one KPI (``start_jobs``), so they replace
    different (KPI, id block) partitions of the target (``blocks.create_blocked_table``); where KPIs share blocks
    (``groups``), the one that commits later replaces its ranges in the newer blocks. Closing touches only the jobs
    that this run started; a conflict there is settled by applying it to the newer ledger. A crash between the
    two leaves RUNNING rows, which a later run retries as stale; the range replace makes that idempotent.
    """
    actions = start_jobs(store, registry, as_of, stale_after=stale_after, initial_from_id=initial_from_id)
    return finish_jobs(store, actions, records, target_table, as_of, version_root=version_root, key=key, id_col=id_col,
                       batch_size=batch_size, min_ids=min_ids, block_size=block_size, groups=groups)


def finish_jobs(store: VersionedTable, actions: DataFrame, records: DataFrame, target_table: str, as_of: str, *, version_root: str,
                key: str = "kpi", id_col: str = "id", batch_size: int = L.BATCH_SIZE, min_ids: int = L.MIN_IDS,
                block_size: int = DEFAULT_BLOCK_SIZE, groups: int | None = None) -> DataFrame:
    """Load the ranges of started ``actions`` and close their jobs in the ledger; the newest ledger."""
    outcomes = _load_actions(actions, records, target_table, version_root=version_root, key=key, id_col=id_col,
                             batch_size=batch_size, min_ids=min_ids, block_size=block_size, groups=groups)
    store.update(lambda version, ledger: L.close_jobs(ledger, outcomes, as_of))
    return store.read()[1]


def incremental_load(spark: SparkSession, registry: DataFrame, ledger: DataFrame, records: DataFrame,
                     target_table: str, as_of: str, *, version_root: str, key: str = "kpi", id_col: str = "id",
                     stale_after: str = L.DEFAULT_STALE_AFTER, batch_size: int = L.BATCH_SIZE,
                     min_ids: int = L.MIN_IDS, initial_from_id: int = 0,
                     ledger_table: str | None = None, block_size: int | None = None, groups: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One run of the incremental loader for all KPIs at once, with the ledger given as a frame (one loader at a
    time; ``run_loader`` takes a shared ledger).

    The target gets a new version (delete each loaded range, insert its rows)
    *before* the ledger is updated, so a crash in between re-runs the same
    ranges, which the range replace makes idempotent. With ``block_size`` the target is laid out by
    (key, id block) or, with ``groups``, (key group, id block) and only the blocks of the loaded ranges are rewritten. With ``ledger_table`` the
    updated ledger is committed as that table's new version (the last step);
    otherwise it is returned unevaluated. Returns ``(new_ledger, target_table_frame)``.
    """
    actions = L.next_actions(registry, ledger, as_of, stale_after=stale_after,
                             initial_from_id=initial_from_id).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        outcomes = _load_actions(actions, records, target_table, version_root=version_root, key=key, id_col=id_col,
                                 batch_size=batch_size, min_ids=min_ids, block_size=block_size, groups=groups)
        new_ledger = L.close_jobs(L.apply_actions(ledger, actions, as_of), outcomes, as_of)
        if ledger_table:
            commit_version(spark, ledger_table, new_ledger, f"{version_root.rstrip('/')}-ledger")
            new_ledger = spark.table(ledger_table)
    finally:
        actions.unpersist()
    return new_ledger, spark.table(target_table)
