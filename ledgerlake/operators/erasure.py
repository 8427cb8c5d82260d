"""Customer erasure: request intake and validation, deletion from the lake,
audit record, request status, notifications.

Requests are a table, not a list on the driver: the ids to erase are joined
with each target, and Spark broadcasts them only if it measures them as small.
A semi-join finds the days that hold rows to delete; only those are read in
full and written anew, and their old files are deleted. A null ``customer_id``
row never matches, so it is kept (``NOT IN`` would drop it and count it as
deleted).

Requests carry ids as text; where tables use another type, the caller passes
the mapping ``to_key``. Ids that are empty, lack the prefix or have no key are
malformed: such requests are rejected, and get no audit row and no notice.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import ts_literal

# Fixed values of the erasure flow.
CUSTOMER_PREFIX = "CUST"
STATUS_PENDING = "PENDING"
STATUS_COMPLETE = "COMPLETE"
STATUS_PARTIAL = "PARTIAL"
STATUS_VALIDATED = "VALIDATED"
STATUS_REJECTED = "REJECTED"
SLA_HOURS = 24
ERROR_REQUIRED = "customer_id is required!"
ERROR_FORMAT = "Invalid customer_id format: "
ERASURE_TARGETS = (
    ("silver", "customers", "silver_customers"),
    ("silver", "transactions", "silver_transactions"),
    ("silver", "kyc", "silver_kyc"),
    ("silver", "support_tickets", "silver_tickets"),
    ("gold", "customer_360", "gold_customer_360"),
    ("gold", "txn_customer_day", "gold_txn_customer_day"),
    ("gold", "txn_customer_values", "gold_txn_customer_values"),
    ("gold", "txn_customer_total", "gold_txn_customer_total"),
    ("gold", "txn_customer_seen", "gold_txn_customer_seen"),
)
# Written only when there is something to write: absent is not missing.
OPTIONAL_TARGETS = (
    ("dlq", "transactions", "dlq_transactions"),
    ("dlq", "customers", "dlq_customers"),
    ("dlq", "kyc", "dlq_kyc"),
    ("dlq", "tickets", "dlq_tickets"),
    ("gold", "customer_360_history", "gold_customer_360_history"),
    ("gold", "txn_customer_sketch", "gold_txn_customer_sketch"),
)


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def request_id(customer_id: Column, at: Column) -> Column:
    return F.concat(F.lit("GDPR-"), customer_id, F.lit("-"), _stamp(at))


def validate_requests(requests: DataFrame, now: Column) -> DataFrame:
    """VALIDATED when the id is non-empty and starts with CUST; otherwise
    REJECTED with the error text."""
    cid = F.col("customer_id")
    empty = cid.isNull() | (cid == "")
    ok = F.coalesce(cid.startswith(CUSTOMER_PREFIX), F.lit(False)) & ~empty
    return requests.select(
        cid.alias("customer_id"),
        F.when(ok, request_id(cid, now)).alias("request_id"),
        F.when(ok, STATUS_VALIDATED).otherwise(STATUS_REJECTED).alias("status"),
        F.when(empty, F.lit(ERROR_REQUIRED))
        .when(~ok, F.concat(F.lit(ERROR_FORMAT), cid)).alias("error"),
        now.alias("validated_at"),
    )


def intake_requests(incoming: DataFrame, requested_at: str = "requested_at") -> DataFrame:
    """Build request rows from incoming (customer_id, requested_at):
    an empty id is rejected (400); others become PENDING (200)."""
    cid = F.col("customer_id")
    at = F.col(requested_at)
    empty = cid.isNull() | (cid == "")
    return incoming.select(
        cid.alias("customer_id"),
        at.alias("requested_at"),
        F.when(empty, F.lit(None)).otherwise(F.lit(STATUS_PENDING)).alias("status"),
        F.when(~empty, request_id(cid, at)).alias("request_id"),
        F.when(~empty, at + F.expr(f"INTERVAL {SLA_HOURS} HOURS")).alias("sla_deadline"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.when(empty, 400).otherwise(200).alias("status_code"),
    )


def pending_requests(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("status") == STATUS_PENDING)


def same_key(customer_id: Column) -> Column:
    """The key of tables that use the requests' own ids."""
    return customer_id


def well_formed(to_key: Callable[[Column], Column] = same_key) -> Column:
    cid = F.col("customer_id")
    return F.coalesce(cid.startswith(CUSTOMER_PREFIX) & to_key(cid).isNotNull(), F.lit(False))


def erasure_keys(pending: DataFrame,
                 to_key: Callable[[Column], Column] = same_key) -> DataFrame:
    """Distinct table keys of pending requests with a well-formed id."""
    return (pending.filter(well_formed(to_key))
            .select(to_key(F.col("customer_id")).alias("customer_id")).distinct())


def anti_join_delete(df: DataFrame, keys: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows of ``df`` whose key is not being erased; null keys are kept."""
    return df.join(keys, on=key, how="left_anti")


SUMMARY_SCHEMA = ("table_name STRING, rows_before LONG, rows_deleted LONG, rows_kept LONG, "
                  "status STRING, error STRING")
AUDIT_SCHEMA = ("batch_id STRING, processed_at TIMESTAMP_NTZ, total_requests INT, "
                "deletion_summary MAP<STRING, BIGINT>, errors MAP<STRING, STRING>, "
                "status STRING")


def erase_table(table, keys: DataFrame, key: str = "customer_id",
                counted: Callable[[int, int], None] = lambda before, deleted: None
                ) -> tuple[int, int]:
    """Delete the keys' rows from a lake table; (rows before, rows deleted).

    ``counted`` is told both numbers before anything is changed.

    One pass over the key and day columns counts rows and hits by day. Of a table with days
    only the days that hold such rows are then read in full and written anew, without a
    shuffle: rows already lie by day. The days' counts reach the driver.
    """
    df, by = table.read(), table.partition_by()
    marked = df.select(key, *([by] if by else [])).join(
        keys.select(key, F.lit(True).alias("_erase")), key, "left")
    counts = marked.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_erase")).alias("hits")).collect()
    before, deleted = sum(r["rows"] for r in counts), sum(r["hits"] for r in counts)
    counted(before, deleted)
    if not deleted:
        return before, 0
    if not by:
        table.write_snapshot(anti_join_delete(df, keys, key))
        return before, deleted
    days = [r[by] for r in counts if r["hits"]]
    named = [d for d in days if d is not None]
    touched = F.col(by).isin(named) if named else F.lit(False)
    if None in days:
        touched = touched | F.col(by).isNull()
    table.replace_partitions(anti_join_delete(df.filter(touched), keys, key), by,
                             days=days, cluster=False, sweep=True)
    return before, deleted


READY = "_ready"


def erase_from_log(spark: SparkSession, path: str, keys: DataFrame, scratch: str,
                   key: str = "customer_id", by: str = "batch_id",
                   counted: Callable[[int, int], None] = lambda before, deleted: None
                   ) -> tuple[int, int]:
    """Delete the keys' rows from an append-only Parquet log with a folder per batch.

    What is left of the batches that hold such rows is written to ``scratch``, in full, and
    marked as ready; then each old batch is replaced by its staged one. A run that finds a ready
    stage goes on replacing before it looks for rows, so whenever a run stops, the rows to
    keep are in the log or in the stage. A stage that is not ready is thrown away.
    Batches without a row to keep are staged as empty folders.
    """
    from ledgerlake.sources import lake as L
    if L.path_exists(spark, f"{scratch}/{READY}"):
        _put_in_place(spark, path, scratch)
    L.delete(spark, scratch)
    df = spark.read.option("mergeSchema", "true").parquet(path)
    keys = keys.select(F.col("customer_id").cast("string").alias(key))
    before = df.count()
    hits = df.join(keys, key, "left_semi").groupBy(by).count()
    hits.write.parquet(f"{scratch}/_hits")
    hits = spark.read.parquet(f"{scratch}/_hits")
    deleted = hits.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    counted(before, deleted)
    if deleted:
        kept = anti_join_delete(df.join(hits.select(by), by, "left_semi"), keys, key)
        kept.write.mode("append").partitionBy(by).parquet(scratch)
        staged = set(L.folders(spark, scratch))
        for row in hits.select(by).toLocalIterator():
            if f"{by}={row[0]}" not in staged:  # all its rows go
                L.make_folder(spark, f"{scratch}/{by}={row[0]}")
        L.touch(spark, f"{scratch}/{READY}")
        _put_in_place(spark, path, scratch)
    L.delete(spark, scratch)
    return before, deleted


def _put_in_place(spark: SparkSession, path: str, scratch: str) -> None:
    """Replace each old batch by the staged one; the staged folder is gone once that is done."""
    from ledgerlake.sources import lake as L
    for batch in L.folders(spark, scratch):
        L.delete(spark, f"{path}/{batch}")
        if [n for n in L.names(spark, f"{scratch}/{batch}") if not n.startswith("_")]:
            L.rename(spark, f"{scratch}/{batch}", f"{path}/{batch}")
        else:
            L.delete(spark, f"{scratch}/{batch}")


STEP_SCHEMA = ("step STRING, rows_before LONG, rows_deleted LONG, status STRING, error STRING, "
               "at TIMESTAMP_NTZ")
STEP_STARTED, STEP_OK, STEP_FAILED, STEP_MISSING = "STARTED", "OK", "FAILED", "MISSING"


class StepLedger:
    """The steps of one erasure batch, each a small JSON document per state it has reached.

    A document is written once a target's rows are counted, before they are deleted, and another
    when that is done. So a run that was stopped can be taken up after its last
    finished step, and its counts stay those of the first attempt.
    """

    def __init__(self, spark: SparkSession, root: str, batch_id: str,
                 clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc)):
        self.spark, self.root, self.batch_id, self.clock = spark, root, batch_id, clock
        self.path = f"{root}/batch_id={batch_id}"

    def write(self, step: str, status: str, before: int = 0, deleted: int = 0,
              error: str | None = None) -> None:
        from ledgerlake.sources.lake import write_text
        doc = {"step": step, "rows_before": before, "rows_deleted": deleted, "status": status,
               "error": error, "at": self.clock().strftime("%Y-%m-%dT%H:%M:%S")}
        write_text(self.spark, f"{self.path}/{step}-{status}.json", json.dumps(doc))

    def reached(self) -> dict[str, dict[str, tuple[int, int]]]:
        """step -> status -> (rows before, rows deleted); a batch has a few dozen documents."""
        from ledgerlake.sources.lake import path_exists
        if not path_exists(self.spark, self.path):
            return {}
        out: dict[str, dict[str, tuple[int, int]]] = {}
        for r in self.spark.read.schema(STEP_SCHEMA).json(self.path).collect():
            out.setdefault(r["step"], {})[r["status"]] = (r["rows_before"], r["rows_deleted"])
        return out


def stored_steps(spark: SparkSession, root: str) -> DataFrame:
    """Every step of every batch: its last state, and whether it was taken up again."""
    docs = spark.read.schema(STEP_SCHEMA + ", batch_id STRING").json(root)
    rank = F.when(F.col("status") == STEP_STARTED, 0).when(F.col("status") == STEP_OK, 2) \
        .otherwise(1)
    return docs.groupBy("batch_id", "step").agg(
        F.max_by(F.struct("status", "rows_before", "rows_deleted", "error", "at"),
                 F.struct(rank, "at")).alias("s")).select("batch_id", "step", "s.*")


class ErasureFailed(RuntimeError):
    """Some targets were not erased, after all were tried; ``rows`` is the summary of them all."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        super().__init__("not erased: " + "; ".join(
            f"{r[0]}: {r[5]}" for r in rows if r[4] != STEP_OK))


def erase_from_lake(lake, keys: DataFrame, targets=ERASURE_TARGETS,
                    optional=OPTIONAL_TARGETS, logs: dict[str, str] | None = None,
                    ledger: StepLedger | None = None, parallel: int = 4, *,
                    partial: bool = False) -> list[tuple]:
    """Delete the keys from every target, and from the logs (label -> path).

    ``parallel`` targets are worked on at once: they share nothing but the keys.

    Returns one tuple per target: (table_name, rows_before, rows_deleted,
    rows_kept, status, error). A target that is MISSING or FAILED may still hold rows of the
    keys: once the others are done, ErasureFailed is raised. With ``partial`` the
    tuples are returned all the same, and the caller must look at them (batch_status).
    With a ``ledger``, targets that it has as done are not read again.
    """
    causes: list[Exception] = []
    keys = keys.cache()
    reached = ledger.reached() if ledger else {}

    def entry(label: str, work: Callable[[Callable], tuple[int, int]]) -> tuple:
        known = reached.get(label, {})
        if STEP_OK in known:
            before, deleted = known[STEP_OK]
            return label, before, deleted, before - deleted, STEP_OK, None

        def counted(before: int, deleted: int) -> None:
            if ledger and STEP_STARTED not in known:
                ledger.write(label, STEP_STARTED, before, deleted)

        try:
            before, deleted = work(counted)
            # what an attempt that was stopped had counted, and may have deleted already
            before, deleted = known.get(STEP_STARTED, (before, deleted))
            if ledger:
                ledger.write(label, STEP_OK, before, deleted)
            return label, before, deleted, before - deleted, STEP_OK, None
        except Exception as e:  # go on with the other targets; the summary names the error
            error = f"{type(e).__name__}: {str(e)[:500]}"
            causes.append(e)
            if ledger:
                ledger.write(label, STEP_FAILED, error=error)
            return label, 0, 0, 0, STEP_FAILED, error

    def of_table(layer: str, name: str, label: str, required: bool) -> tuple | None:
        table = lake.table(layer, name)
        if table.exists():
            return entry(label, lambda counted: erase_table(table, keys, counted=counted))
        return (label, 0, 0, 0, STEP_MISSING, f"no table {table.name}") if required else None

    def of_log(label: str, path: str) -> tuple:
        return entry(label, lambda counted: erase_from_log(
            lake.spark, path, keys, f"{lake.root}/staging/{label}", counted=counted))

    work = [*[(of_table, (*t, True)) for t in targets], *[(of_table, (*t, False)) for t in optional],
            *[(of_log, x) for x in (logs or {}).items()]]
    try:
        if parallel > 1:
            with ThreadPoolExecutor(parallel) as pool:
                rows = list(pool.map(lambda x: x[0](*x[1]), work))
        else:
            rows = [step(*args) for step, args in work]
    finally:
        keys.unpersist()
    rows = [r for r in rows if r]
    if not partial and batch_status(rows) != STATUS_COMPLETE:
        raise ErasureFailed(rows) from next(iter(causes), None)
    return rows


def sla_status(requests: DataFrame, now: Column) -> DataFrame:
    """requests with ``sla``: MET or LATE once complete, else OPEN or OVERDUE at ``now``."""
    done = F.col("status") == STATUS_COMPLETE
    due = F.col("sla_deadline")
    return requests.withColumn("sla", F.when(
        done, F.when(F.col("completed_at") <= due, "MET").otherwise("LATE"))
        .when(F.col("status") == STATUS_PENDING, F.when(now <= due, "OPEN").otherwise("OVERDUE")))


def summary_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def batch_status(rows: list[tuple]) -> str:
    return STATUS_COMPLETE if all(r[4] == "OK" for r in rows) else STATUS_PARTIAL


def audit_record(spark: SparkSession, batch_id: str, processed_at: dt.datetime,
                 total_requests: int, rows: list[tuple]) -> DataFrame:
    """The audit header: one row per batch. The erased ids themselves go to
    ``audit_ids`` (one row each), so no id list is gathered into one row."""
    summary = {r[0]: int(r[2]) for r in rows}
    errors = {r[0]: r[5] for r in rows if r[5]}
    return spark.createDataFrame(
        [(batch_id, processed_at, int(total_requests), summary, errors, batch_status(rows))],
        AUDIT_SCHEMA)


AUDIT_IDS_SCHEMA = ("batch_id STRING, customer_id STRING, request_id STRING, "
                    "requested_at TIMESTAMP_NTZ")


def audit_ids(pending: DataFrame, batch_id: str) -> DataFrame:
    return pending.select(F.lit(batch_id).alias("batch_id"), "customer_id", "request_id",
                          "requested_at")


def update_request_status(requests: DataFrame, processed: DataFrame, audit_key: str,
                          completed_at: dt.datetime,
                          rejected: DataFrame | None = None) -> DataFrame:
    """Mark processed (customer_id, requested_at) keys COMPLETE, rejected ones REJECTED."""
    marks = processed.select("customer_id", "requested_at",
                             F.lit(STATUS_COMPLETE).alias("_new"))
    if rejected is not None:
        marks = marks.unionByName(rejected.select("customer_id", "requested_at",
                                                  F.lit(STATUS_REJECTED).alias("_new")))
    joined = requests.join(marks.distinct(), on=["customer_id", "requested_at"], how="left")
    done = F.col("_new") == STATUS_COMPLETE
    cols = [c for c in requests.columns if c not in ("status", "completed_at", "audit_log_key")]
    return joined.select(
        *cols,
        F.coalesce(F.col("_new"), F.col("status")).alias("status"),
        F.when(done, ts_literal(completed_at)).otherwise(F.col("completed_at"))
        .alias("completed_at"),
        F.when(done, F.lit(audit_key)).otherwise(
            F.col("audit_log_key") if "audit_log_key" in requests.columns
            else F.lit(None).cast("string")).alias("audit_log_key"),
    )
