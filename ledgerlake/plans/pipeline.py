"""End-to-end jobs: the daily bronze -> silver -> gold run and the erasure run.

These are the only functions that trigger actions (writes); every step in
between is a lazy DataFrame. Counts come from ``observe`` on the writes, not
from extra ``count()`` jobs. Reruns of a day replace that day, so the
pipeline is safe to retry after a lost executor or a failed attempt.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import clean, erasure, history, marts, notify, quality, sketches
from ledgerlake.sources import lake as L


@dataclass
class RunReport:
    run_date: dt.date
    counts: dict = field(default_factory=dict)
    quality: DataFrame | None = None


def default_run_date(today: dt.date | None = None) -> dt.date:
    """The job date when none is given: yesterday."""
    return (today or dt.date.today()) - dt.timedelta(days=1)


BRONZE_ENTITIES = ("customers", "kyc", "support_tickets")


def refresh_catalog(spark: SparkSession, lake: L.Lake, run_date: dt.date | None = None,
                    database: str | None = None) -> str:
    """Register the four raw datasets; returns the database.

    Transactions are a table partitioned by day. With ``run_date`` only that day's folder is
    added and only its files are checked for new columns (new folders only, as a daily crawl);
    without it every folder is discovered (MSCK REPAIR) and all files are checked.
    """
    database = database or f"{lake.database}_bronze"
    # the namespace lives with the lake, not in a local warehouse folder
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
              f"LOCATION '{lake.root}/catalog/{database}.db'")
    name = f"{database}.transactions"
    root = lake.bronze_path("transactions")
    # schema and the year/month/day partitioning are inferred from the folder
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{root}'")
    if run_date is None:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        add_new_columns(spark, name, root)
    else:
        spec = f"year={run_date.year}, month={run_date.month}, day={run_date.day}"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
        add_new_columns(spark, name, L.day_folder(root, run_date))
    for entity in BRONZE_ENTITIES:
        path = lake.bronze_path(entity)
        if L.path_exists(spark, path):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{entity} USING parquet "
                      f"LOCATION '{path}'")
            add_new_columns(spark, f"{database}.{entity}", path)
            spark.catalog.refreshTable(f"{database}.{entity}")
    return database


def add_new_columns(spark: SparkSession, name: str, path: str) -> list[str]:
    """Add columns that newer files carry but the table does not: a repair
    finds new folders only, so the merged file schema is compared with the
    table's and the difference is added with ALTER TABLE. A column whose type
    changed is an error, a missing folder is not."""
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    known = {f.name.lower(): f.dataType for f in spark.table(name).schema}
    for f in merged:
        if known.get(f.name.lower(), f.dataType) != f.dataType:
            raise L.SchemaConflict(f"{name}.{f.name} is {known[f.name.lower()].simpleString()}, "
                                   f"not {f.dataType.simpleString()}")
    new = [f for f in merged if f.name.lower() not in known]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    return [f.name for f in new]


def run_silver(spark: SparkSession, lake: L.Lake, run_date: dt.date, run_ts: dt.datetime,
               suppressed: DataFrame | None = None) -> dict:
    """Bronze -> silver for one day of transactions plus the three entity
    snapshots. ``suppressed`` customer keys (past erasures) never re-enter."""
    counts = {}
    day_txn = L.scan_parquet_day(spark, lake.bronze_path("transactions"), run_date)
    entities = {
        "customers": (L.scan_parquet(spark, lake.bronze_path("customers")),
                      clean.silver_customers),
        "kyc": (L.scan_parquet(spark, lake.bronze_path("kyc")), clean.silver_kyc),
        "support_tickets": (L.scan_parquet(spark, lake.bronze_path("support_tickets")),
                            clean.silver_support_tickets),
    }

    def keep(df):
        if suppressed is None:
            return df
        return df.join(suppressed, on="customer_id", how="left_anti")

    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        """Keep the deduplicated rows for the good and the dead-letter write."""
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    good, bad = clean.silver_transactions(keep(day_txn), run_date, run_ts, prepare=hold)
    table = lake.table("silver", "transactions")
    obs = Observation()
    table.replace_partitions(good.observe(obs, F.count(F.lit(1)).alias("rows")),
                             "transaction_date", days=[run_date])
    counts["silver_transactions"] = int(obs.get.get("rows") or 0)
    counts["dlq_transactions"] = L.write_dlq(bad, lake.table("dlq", "transactions"), run_date)
    held.pop().unpersist()
    for name, (bronze, job) in entities.items():
        good, bad = job(keep(bronze), run_date, run_ts, prepare=hold)
        obs = Observation()
        lake.table("silver", name).write_snapshot(
            good.observe(obs, F.count(F.lit(1)).alias("rows")))
        counts[f"silver_{name}"] = int(obs.get.get("rows") or 0)
        counts[f"dlq_{name}"] = L.write_dlq(
            bad, lake.table("dlq", clean.DLQ_SOURCES[name]), run_date)
        held.pop().unpersist()
    return counts


def _silver(lake: L.Lake) -> dict:
    return {n: lake.table("silver", n).read()
            for n in ("transactions", "customers", "kyc", "support_tickets")}


STATE_TABLES = (("gold", "txn_customer_day"), ("gold", "txn_customer_values"))


def update_summary_state(lake: L.Lake, run_date: dt.date | None = None) -> None:
    """Replace one day of the incremental summary state (all days when the
    state does not exist yet, or when ``run_date`` is None)."""
    txn = lake.table("silver", "transactions").read()
    partials = lake.table(*STATE_TABLES[0])
    values = lake.table(*STATE_TABLES[1])
    if run_date is None or not partials.exists() or not values.exists():
        partials.write_snapshot(marts.customer_day_partials(txn), "transaction_date")
        values.write_snapshot(marts.customer_day_values(txn), "transaction_date")
        return
    day = txn.filter(F.col("transaction_date") == F.lit(run_date))
    partials.replace_partitions(marts.customer_day_partials(day), "transaction_date",
                                days=[run_date])
    values.replace_partitions(marts.customer_day_values(day), "transaction_date",
                              days=[run_date])


TOTAL_TABLE, SEEN_TABLE = ("gold", "txn_customer_total"), ("gold", "txn_customer_seen")


def day_step(lake: L.Lake, run_date: dt.date,
             before: dt.date) -> tuple[DataFrame, DataFrame]:
    """(totals as of ``run_date``, values first seen that day), from the state of that day and
    the totals as of ``before``. Rows of other days are read only in the set of seen values."""
    day = F.col("transaction_date") == F.lit(run_date)
    partials, values = (lake.table(*t).read().filter(day) for t in STATE_TABLES)
    seen = lake.table(*SEEN_TABLE).read().filter(F.col("first_day") < F.lit(run_date))
    new = marts.newly_seen(values, seen)
    totals = lake.table(*TOTAL_TABLE).read().filter(F.col("as_of") == F.lit(before)).drop("as_of")
    return marts.add_totals(totals, marts.customer_totals(partials, new)), new


def update_totals(lake: L.Lake, run_date: dt.date) -> dt.date:
    """Bring the totals up to ``run_date``; returns the day they are as of.

    A rerun of the newest day starts from the day before it, which is kept. Where the run day
    lies before the totals' newest day, or nothing precedes it, all state is summed up anew.
    """
    totals, seen = lake.table(*TOTAL_TABLE), lake.table(*SEEN_TABLE)
    have = [] if not totals.exists() else sorted(
        r[0] for r in totals.read().select("as_of").distinct().collect())  # two days at most
    before = [d for d in have if d < run_date]
    if not before or have[-1] > run_date:
        partials, values = (lake.table(*t).read() for t in STATE_TABLES)
        seen.write_snapshot(marts.first_seen(values), "first_day")
        last = partials.agg(F.max("transaction_date")).first()[0] or run_date
        totals.write_snapshot(marts.customer_totals(partials, seen.read()).withColumn(
            "as_of", F.lit(last)), "as_of")
        return last
    new_totals, new = day_step(lake, run_date, before[-1])
    # the values first, then the totals: a crash between the two is mended by the rerun
    seen.replace_partitions(new.withColumn("first_day", F.lit(run_date)), "first_day",
                            days=[run_date])
    totals.replace_partitions(new_totals.withColumn("as_of", F.lit(run_date)), "as_of",
                              days=[run_date, *before[:-1]])
    return run_date


SKETCH_TABLE = ("gold", "txn_customer_sketch")


def update_sketches(lake: L.Lake, run_date: dt.date) -> dt.date:
    """Bring the sketched state up to ``run_date``; returns the day it is as of.

    Reads one day of silver and the state of the day before, a row per customer. As with the
    exact totals, a rerun of the newest day starts from the day before it; a run of
    an earlier day, or the first, sums up silver anew.
    """
    table = lake.table(*SKETCH_TABLE)
    txn = lake.table("silver", "transactions").read()
    have = [] if not table.exists() else sorted(
        r[0] for r in table.read().select("as_of").distinct().collect())  # two days at most
    before = [d for d in have if d < run_date]
    if not before or have[-1] > run_date:
        last = txn.agg(F.max("transaction_date")).first()[0] or run_date
        table.write_snapshot(sketches.state_of(txn).withColumn("as_of", F.lit(last)), "as_of")
        return last
    day = sketches.state_of(txn.filter(F.col("transaction_date") == F.lit(run_date)))
    old = table.read().filter(F.col("as_of") == F.lit(before[-1])).drop("as_of")
    table.replace_partitions(sketches.add_state(old, day).withColumn("as_of", F.lit(run_date)),
                             "as_of", days=[run_date, *before[:-1]])
    return run_date


def customer_360_of(lake: L.Lake, run_date: dt.date, run_ts: dt.datetime) -> DataFrame:
    """customer_360 from the whole stored silver history; the distinct counts come from a
    second, narrow read of it instead of a five-fold Expand."""
    silver = _silver(lake)
    return marts.customer_360_from_summary(
        silver["customers"], silver["kyc"],
        marts.transaction_summary(silver["transactions"], distinct="narrow"),
        silver["support_tickets"], run_date, run_ts)


def run_gold_customer_360(spark: SparkSession, lake: L.Lake, run_date: dt.date,
                          run_ts: dt.datetime, incremental: bool = False,
                          distinct: str = "exact") -> int:
    """Write customer_360 anew.

    ``incremental`` merges the run day into the totals per customer; otherwise the whole
    silver history is read, with the distinct counts from a second narrow read of the stored,
    columnar transactions instead of a five-fold Expand. With ``distinct="sketch"`` the
    incremental distinct counts are estimates from merged sketches, and no set of values is kept.
    """
    if distinct not in ("exact", "sketch"):
        raise ValueError(f"distinct counts are exact or sketch, not {distinct}")
    silver = _silver(lake)
    if incremental and distinct == "sketch":
        as_of = update_sketches(lake, run_date)
        summary = sketches.summary_from_state(
            lake.table(*SKETCH_TABLE).read().filter(F.col("as_of") == F.lit(as_of)).drop("as_of"))
    elif incremental:
        update_summary_state(lake, run_date)
        as_of = update_totals(lake, run_date)
        summary = marts.summary_from_totals(
            lake.table(*TOTAL_TABLE).read().filter(F.col("as_of") == F.lit(as_of)))
    else:
        summary = marts.transaction_summary(silver["transactions"], distinct="narrow")
    c360 = marts.customer_360_from_summary(silver["customers"], silver["kyc"], summary,
                                           silver["support_tickets"], run_date, run_ts)
    obs = Observation()
    lake.table("gold", "customer_360").write_snapshot(
        c360.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get.get("rows") or 0)


HISTORY_TABLE = ("gold", "customer_360_history")


def update_customer_history(lake: L.Lake, run_date: dt.date) -> None:
    """Load the gold customer_360 of run_date into its type-2 history."""
    history.load_history(lake.table(*HISTORY_TABLE), lake.table("gold", "customer_360").read(),
                         "customer_id", run_date)


def run_gold(spark: SparkSession, lake: L.Lake, run_date: dt.date,
             run_ts: dt.datetime, incremental: bool = True, keep_history: bool = False,
             distinct: str = "exact") -> dict:
    counts = {"gold_customer_360": run_gold_customer_360(spark, lake, run_date, run_ts,
                                                         incremental, distinct)}
    if keep_history:
        update_customer_history(lake, run_date)
    silver = _silver(lake)
    daily = marts.daily_aggregates(silver["transactions"], run_ts, run_date)
    lake.table("gold", "daily_aggregates").replace_partitions(
        daily, "transaction_date", days=[run_date])
    report = marts.regulatory_report(silver["transactions"], run_date, run_ts)
    lake.table("gold", "regulatory_reports").replace_partitions(
        report, "report_date", days=[run_date])
    return counts


def run_daily(spark: SparkSession, lake: L.Lake, run_date: dt.date | None = None,
              run_ts: dt.datetime | None = None, min_rows: int = quality.DAILY_MIN_ROWS,
              register_catalog: bool = True, keep_history: bool = False,
              distinct: str = "exact") -> RunReport:
    """catalog refresh -> silver -> quality gate -> gold -> notification.

    ``keep_history`` also loads customer_360 into its type-2 history; ``distinct`` is as in
    ``run_gold_customer_360``.
    """
    run_date = run_date or default_run_date()
    run_ts = run_ts or dt.datetime.combine(run_date + dt.timedelta(days=1), dt.time(1))
    report = RunReport(run_date)
    step = "catalog"
    try:
        if register_catalog:
            refresh_catalog(spark, lake, run_date)
        step = "silver"
        suppressed = suppression_list(spark, lake)
        report.counts.update(run_silver(spark, lake, run_date, run_ts, suppressed))
        step = "quality_gate"
        day = lake.table("silver", "transactions").read().filter(
            F.col("transaction_date") == F.lit(run_date))
        report.quality = quality.gate(
            quality.run_suite(spark, "gate", day, quality.gate_rules(min_rows)))
        step = "gold"
        report.counts.update(run_gold(spark, lake, run_date, run_ts, keep_history=keep_history,
                                      distinct=distinct))
    except Exception:
        notify.write_outbox(notify.pipeline_failure(spark, "daily_pipeline", step, run_date,
                                                    run_ts), lake.outbox_path(),
                            f"daily-{run_date}")
        raise
    notify.write_outbox(notify.pipeline_success(spark, "daily_pipeline", run_date, run_ts),
                        lake.outbox_path(), f"daily-{run_date}")
    return report


# ---- erasure ----------------------------------------------------------------------

def suppression_list(spark: SparkSession, lake: L.Lake) -> DataFrame | None:
    """Keys of customers already erased; silver loads anti-join them so a
    reload from raw files does not bring them back."""
    t = lake.table("control", "erased_customers")
    return t.read().select("customer_id").distinct() if t.exists() else None


REQUEST_KEY = ["customer_id", "requested_at"]


def insert_requests(lake: L.Lake, requests: DataFrame) -> int:
    """Add requests to the stored table; one that is there already stays as it is."""
    return lake.table("control", "deletion_requests").append(requests, REQUEST_KEY)


FINISH = "finish"


def open_batch(spark: SparkSession, lake: L.Lake) -> str | None:
    """The erasure batch that was begun and not finished, if there is one."""
    if not L.path_exists(spark, lake.steps_path()):
        return None
    steps = erasure.stored_steps(spark, lake.steps_path())
    return steps.groupBy("batch_id").agg(
        F.max((F.col("step") == FINISH) & (F.col("status") == erasure.STEP_OK)).alias("done")) \
        .filter(~F.col("done")).agg(F.min("batch_id")).first()[0]


def run_erasure(spark: SparkSession, lake: L.Lake, requests: DataFrame | None,
                run_ts: dt.datetime, to_key: Callable[[Column], Column] = erasure.same_key,
                logs: dict[str, str] | None = None, parallel: int = 4) -> dict:
    """Pending requests -> delete from the lake -> audit -> status -> notices.

    ``requests`` are inserted into the stored table first, and the new status is stored there:
    COMPLETE for the requests of a complete batch, REJECTED for malformed ids; requests of a
    PARTIAL batch stay PENDING for the next run. ``to_key`` maps a request's id to the tables'
    key; ``logs`` are further Parquet logs (label -> path) to erase from; ``parallel`` targets
    are worked on at once. Returns the batch id, the summary per table, and the stored requests.

    Each step is kept in a ledger. A run that finds a batch begun and not finished takes that
    one up, with the requests it began with, after its last finished step; requests
    that came since wait for the next run.
    """
    stored = lake.table("control", "deletion_requests")
    if requests is not None:
        insert_requests(lake, requests)
    batch_id = open_batch(spark, lake)
    resumed = batch_id is not None
    batch_id = batch_id or f"GDPR-BATCH-{run_ts.strftime('%Y%m%d%H%M%S')}"
    ledger = erasure.StepLedger(spark, lake.steps_path(), batch_id, clock=lambda: run_ts)
    members = f"{lake.root}/batches/batch_id={batch_id}"
    pending = erasure.pending_requests(stored.read())
    if resumed:
        begun = spark.read.parquet(members).select(*REQUEST_KEY)
        pending = pending.join(begun, REQUEST_KEY, "left_semi")
    pending = pending.cache()
    valid = pending.filter(erasure.well_formed(to_key))
    malformed = pending.filter(~erasure.well_formed(to_key))
    n_valid, n_pending = valid.count(), pending.count()
    if n_pending == 0:
        pending.unpersist()
        if resumed:  # it was stopped after the statuses were stored
            ledger.write(FINISH, erasure.STEP_OK)
        return {"batch_id": None, "summary": [], "requests": stored.read()}
    if not resumed:
        L.delete(spark, ledger.path)  # of a finished batch of the same time
        pending.select(*REQUEST_KEY).write.mode("overwrite").parquet(members)
        ledger.write(FINISH, erasure.STEP_STARTED)
    keys = erasure.erasure_keys(valid, to_key)
    audit_key = f"{lake.audit_path()}/batch_id={batch_id}"
    rows, status = [], None
    if n_valid:
        # record the suppression first: a crash after this point re-runs safely
        lake.table("control", "erased_customers").append(
            keys.select("customer_id", F.lit(batch_id).alias("batch_id")), ["customer_id"])
        rows = erasure.erase_from_lake(lake, keys, logs=logs, ledger=ledger, parallel=parallel,
                                       partial=True)
        erasure.audit_record(spark, batch_id, run_ts, n_valid, rows).coalesce(1) \
            .write.mode("overwrite").json(f"{audit_key}/header")
        erasure.audit_ids(valid, batch_id).write.mode("overwrite").json(f"{audit_key}/ids")
        status = erasure.batch_status(rows)
    done = valid if status == erasure.STATUS_COMPLETE else valid.limit(0)
    if status == erasure.STATUS_COMPLETE:
        notify.write_outbox(notify.deletion_complete(valid, run_ts), lake.outbox_path(), batch_id)
    stored.write_snapshot(erasure.update_request_status(stored.read(), done, audit_key, run_ts,
                                                        malformed))
    ledger.write(FINISH, erasure.STEP_OK)
    pending.unpersist()
    return {"batch_id": batch_id, "summary": rows, "requests": stored.read(),
            "audit_key": audit_key, "status": status}


# ---- fraud decisions: merge-on-read log ------------------------------------------------

def append_decisions(decisions: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch of decisions under its own batch folder; a
    replayed batch replaces its folder, so the write is idempotent."""
    (decisions.withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def current_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Latest decision per transaction_id: the last batch wins, then the
    last arrival inside it (one aggregate, not a window)."""
    log = spark.read.option("mergeSchema", "true").parquet(path)
    return last_arrival(log, ["batch_id"]).drop("batch_id", "seq")


def last_arrival(decided: DataFrame, before: list[str]) -> DataFrame:
    """The last row per transaction_id by ``before``, then by sequence number.

    Sequence numbers are text of digits: the longer is the later, then the
    greater; one without a number comes first.
    """
    if "seq" not in decided.columns:
        return clean.dedup_by_key(decided, "transaction_id", before)
    digits = decided.withColumn("_digits", F.coalesce(F.length("seq"), F.lit(0)))
    return clean.dedup_by_key(digits, "transaction_id", [*before, "_digits", "seq"]) \
        .drop("_digits")


# Folded batches get ids below all stream batches; a later fold the greater one.
FOLDED_BASE = -(1 << 50)
FOLD_MARK = "_folded-"


def compact_decisions(spark: SparkSession, path: str) -> int:
    """Fold the log into one folder and delete the batches it holds (run between batches).

    The folded rows come under a new batch id, FOLDED_BASE + the last batch folded, which every
    stream batch outranks and every earlier fold does not. A mark says that they are
    whole; only then are the batches they hold deleted. A fold without a mark is
    of a run that was stopped while writing, and is made anew. So whenever a run stops,
    each decision is in a whole fold or in its batch, and a reader gets the same latest
    ones. A batch that the stream replays after it was folded brings the rows it had.
    Returns the rows left.
    """
    def log() -> DataFrame:
        return spark.read.option("mergeSchema", "true").parquet(path)

    whole = [int(n.removeprefix(FOLD_MARK)) for n in L.names(spark, path)
             if n.startswith(FOLD_MARK)]
    if whole:
        _drop_folded(spark, path, max(whole))
    last = log().filter(F.col("batch_id") >= 0).agg(F.max("batch_id")).first()[0]
    if last is not None:
        target = FOLDED_BASE + last
        L.delete(spark, f"{path}/batch_id={target}")  # not whole, or it would hold this batch
        (last_arrival(log(), ["batch_id"]).withColumn("batch_id", F.lit(target))
         .write.mode("append").partitionBy("batch_id").parquet(path))
        L.touch(spark, f"{path}/{FOLD_MARK}{last}")
        _drop_folded(spark, path, last)
    return log().count()


def _drop_folded(spark: SparkSession, path: str, last: int) -> None:
    """Delete what the whole fold of the batches up to ``last`` holds."""
    for folder in L.folders(spark, path):
        batch = int(folder.rsplit("=", 1)[1])
        if batch <= last and batch != FOLDED_BASE + last:
            L.delete(spark, f"{path}/{folder}")
    for name in L.names(spark, path):
        if name.startswith(FOLD_MARK) and name != f"{FOLD_MARK}{last}":
            L.delete(spark, f"{path}/{name}")
