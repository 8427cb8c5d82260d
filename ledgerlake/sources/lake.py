"""Lake layout: bronze day folders, catalog tables for silver, gold, control and dead letters.

A lake table is an external Parquet table of the Spark catalog. Every write
goes to a new folder; the table, or the days it brings, are then pointed at
that folder (``ALTER TABLE ... SET LOCATION``), and the folder it replaces is
deleted. A job that dies before the swap leaves the table as it was, and a
rerun starts a new folder. Readers see the catalog's schema: columns that come
later are added to it, and are null in older files.

A cluster needs a persistent catalog (a metastore) for tables to outlive the
session; the lake itself only issues catalog statements.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import scratch_path

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class SchemaConflict(ValueError):
    """A column arrives with another type than the table has."""


class LakeTable:
    """One catalog table whose data lies below ``root``; writers are serialised
    (one run at a time), as in the reference deployment."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name, self.root = spark, name, root.rstrip("/")

    # ---- reading ----

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no table {self.name}")
        return self.spark.table(self.name)

    def partition_by(self) -> str | None:
        parts = [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]
        return parts[0] if parts else None

    def location(self, spec: str = "") -> str | None:
        """The folder of the table, or of the partition ``spec``; None if there is none."""
        try:
            rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} {spec}") \
                .filter("col_name = 'Location'").collect()
        except AnalysisException as e:
            if e.getCondition() and "PARTITION" in e.getCondition():
                return None
            raise
        return rows[0]["data_type"] if rows else None

    # ---- writing ----

    def _stage(self, df: DataFrame, partition_by: str | None, cluster: bool = True) -> str:
        path = f"{self.root}/load-{uuid.uuid4().hex[:12]}"
        if partition_by:
            out = clustered(df, partition_by) if cluster else df
            out.write.partitionBy(partition_by).parquet(path)
        else:
            df.write.parquet(path)
        return path

    def _declare(self, schema: StructType, partition_by: str | None, path: str) -> bool:
        """Create the table, or add the columns it does not know; True if it is new."""
        if not self.exists():
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            by = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
            self.spark.sql(f"CREATE TABLE {self.name} ({cols}) USING parquet {by} "
                           f"LOCATION '{path}'")
            return True
        known = {f.name: f.dataType for f in self.spark.table(self.name).schema}
        for f in schema:
            if f.name in known and known[f.name] != f.dataType:
                raise SchemaConflict(f"{self.name}.{f.name} is {known[f.name].simpleString()}, "
                                     f"not {f.dataType.simpleString()}")
        new = [f for f in schema if f.name not in known]
        if new:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({cols})")
        return False

    def write_snapshot(self, df: DataFrame, partition_by: str | None = None) -> None:
        """Replace the whole table by ``df``."""
        if partition_by:
            self.replace_partitions(df, partition_by, drop_others=True)
            return
        path = self._stage(df, None)
        old = self.location() if self.exists() else None
        if not self._declare(df.schema, None, path):
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{path}'")
            self._purge(old)

    def replace_partitions(self, df: DataFrame, partition_by: str, days: list | None = None,
                           drop_others: bool = False, cluster: bool = True,
                           sweep: bool = False) -> None:
        """Replace the days that ``df`` holds, each by a swap of its folder.

        A day named in ``days`` that ``df`` leaves empty is dropped, if the table has it;
        nothing else is touched. The names of the days in this load reach the driver, as
        catalog statements need them. Of a few days the replaced folders are known and
        deleted; with ``sweep``, or for many days, all loads are searched for
        copies of these days, those of crashed loads included.
        """
        path = self._stage(df, partition_by, cluster)
        new_table = self._declare(df.schema, partition_by, path)
        staged = folders(self.spark, path)
        named = None if drop_others else [f"{partition_by}={d}" for d in days or []] + staged
        old = {} if new_table else self._partitions(named)
        add = [p for p in staged if p not in old]
        if add:
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS " + " ".join(
                f"{spec_of(p)} LOCATION '{path}/{p}'" for p in add))
        together(lambda p: self.spark.sql(
            f"ALTER TABLE {self.name} {spec_of(p)} SET LOCATION '{path}/{p}'"),
            [p for p in staged if p in old])
        gone = sorted(set(old).difference(staged))
        if gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS "
                           + ", ".join(map(spec_of, gone)))
        if sweep or None in old.values():
            self._purge_days(path, [*staged, *gone])
        else:
            for folder in old.values():
                self._purge(folder)

    def append(self, df: DataFrame, key: list[str]) -> int:
        """Insert the rows whose key the table does not hold; returns their number."""
        if not self.exists():
            self.write_snapshot(df.dropDuplicates(key))
            return self.read().count()
        self._declare(df.schema, None, self.location())
        known = self.read()
        new = df.dropDuplicates(key).join(known.select(*key), key, "left_anti")
        rows = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(t).alias(c)
                            for c, t in known.dtypes])
        before = known.count()
        rows.write.mode("append").insertInto(self.name)
        return self.read().count() - before

    def share(self, other: "LakeTable") -> None:
        """Make this table read another's folder, which is never purged from here.

        The other's days must all lie in the folder of its first load.
        """
        by = other.partition_by()
        self._declare(other.read().schema, by, other.location())
        if by:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
            if self._partitions(None) != other._partitions(None):
                raise ValueError(f"{other.name} was loaded in several steps")

    def _partitions(self, wanted: list[str] | None) -> dict[str, str | None]:
        """The partitions the table has, of the wanted ones or of all, with their folders where
        few were asked for."""
        if wanted is not None and len(set(wanted)) <= FEW_DAYS:
            found = {p: self.location(spec_of(p)) for p in dict.fromkeys(wanted)}
            return {p: at for p, at in found.items() if at is not None}
        have = {r["partition"] for r in
                self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        return dict.fromkeys(have if wanted is None else have & set(wanted))

    def _purge(self, path: str | None) -> None:
        """Delete a replaced folder, if it is this table's own."""
        if path and norm(path).startswith(norm(self.root) + "/"):
            fs, target = file_system(self.spark, path)
            fs.delete(target, True)

    def _purge_days(self, path: str, days: list[str]) -> None:
        """Delete these days' folders of all earlier loads (a crashed one's too), and loads
        that are left without a day, so that only live ones are searched next time."""
        own = path.rsplit("/", 1)[-1]

        def sweep(load: str) -> None:
            there = folders(self.spark, f"{self.root}/{load}")
            for name in set(days).intersection(there):
                delete(self.spark, f"{self.root}/{load}/{name}")
            if there and not set(there).difference(days):
                delete(self.spark, f"{self.root}/{load}")

        together(sweep, [n for n in names(self.spark, self.root) if n != own])


FEW_DAYS = 8
# Catalog statements and folder listings that the driver has under way at once.
DRIVER_CALLS = 8


def together(call, items: list) -> None:
    """call(item) for every item, a few at once; the first error is raised."""
    if len(items) < 2:
        for item in items:
            call(item)
        return
    with ThreadPoolExecutor(DRIVER_CALLS) as pool:
        list(pool.map(call, items))


def norm(path: str) -> str:
    """One spelling of a local path's scheme."""
    return "file:/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) \
        else path


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders directly below a path."""
    fs, target = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)
                  if f.isDirectory() and "=" in f.getPath().getName())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a path; none if it is missing."""
    fs, target = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) \
        else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, target = file_system(spark, path)
    if not fs.delete(target, True) and fs.exists(target):
        raise OSError(f"cannot delete {path}")


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder to a place that is free."""
    fs, source = file_system(spark, old)
    target = file_system(spark, new)[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"cannot move {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.mkdirs(target)


def touch(spark: SparkSession, path: str) -> None:
    """Write an empty file: a mark that Spark's readers do not see if its name begins with _."""
    fs, target = file_system(spark, path)
    fs.create(target, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under a hidden name first, then moved to its own."""
    folder, _, name = path.rpartition("/")
    fs, draft = file_system(spark, f"{folder}/_{name}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    delete(spark, path)
    rename(spark, f"{folder}/_{name}", path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def spec_of(folder: str) -> str:
    """``PARTITION (col='value')`` of a partition folder's name."""
    col, _, value = folder.partition("=")
    value = unquote(value)
    if value == NO_VALUE:
        return f"PARTITION (`{col}`=NULL)"
    return "PARTITION (`{}`='{}')".format(col, value.replace("\\", "\\\\").replace("'", "\\'"))


def clustered(df: DataFrame, partition_col: str) -> DataFrame:
    """Group rows by the output partition before a partitioned write, so a
    day lands in a few files instead of one per task; AQE splits a day that
    is too big for one task and merges small ones (REBALANCE)."""
    return df.hint("rebalance", partition_col)


class Lake:
    """Folders and catalog tables of one lake.

    The tables are ``<database>.<layer>_<name>``; the database lies with the lake and is
    named after its folder.
    """

    def __init__(self, spark: SparkSession, root: str, bronze_root: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._bronze_root = (bronze_root or f"{self.root}/bronze").rstrip("/")
        tail = "".join(c if c.isalnum() else "_" for c in self.root.rsplit("/", 1)[-1])
        self.database = f"lake_{tail}".lower()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} "
                  f"LOCATION '{self.root}/catalog'")

    @classmethod
    def scratch(cls, spark: SparkSession, tag: str = "lake",
                bronze_root: str | None = None) -> "Lake":
        """A lake in a new, empty folder under the shared directory; raw
        files may come from another lake's bronze folder."""
        return cls(spark, scratch_path(spark, tag), bronze_root=bronze_root)

    def share(self, other: "Lake") -> "Lake":
        """Take over another lake's tables by reference: no data is copied, and what this
        lake writes or deletes never touches the other's folders."""
        for row in self.spark.sql(f"SHOW TABLES IN {other.database}").collect():
            layer, _, name = row["tableName"].partition("_")
            self.table(layer, name).share(other.table(layer, name))
        return self

    def bronze_path(self, entity: str) -> str:
        return f"{self._bronze_root}/{entity}"

    def table(self, layer: str, name: str) -> LakeTable:
        return LakeTable(self.spark, f"{self.database}.{layer}_{name}",
                         f"{self.root}/{layer}/{name}")

    def outbox_path(self) -> str:
        return f"{self.root}/outbox"

    def audit_path(self) -> str:
        return f"{self.root}/audit"

    def steps_path(self) -> str:
        return f"{self.root}/steps"


# ---- bronze -------------------------------------------------------------------

def write_bronze_days(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """Land raw rows in ``year=/month=/day=`` folders (the simulators' layout)."""
    days = (df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))
            .withColumn("day", F.dayofmonth(ts_col)))
    (days.hint("rebalance", "year", "month", "day")
     .write.mode("overwrite").partitionBy("year", "month", "day").parquet(path))


def write_bronze_entity(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def day_folder(root: str, day: dt.date) -> str:
    return f"{root}/year={day.year}/month={day.month}/day={day.day}"


def _days(spark: SparkSession, root: str, days: list[dt.date]) -> DataFrame:
    """The days' files only: other days are not even listed. A day without a
    folder has no rows; columns that only some of the files have are kept."""
    there = [f for f in (day_folder(root, d) for d in days) if path_exists(spark, f)]
    if not there:
        return spark.read.parquet(root).limit(0).drop("year", "month", "day")
    return (spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*there)
            .drop("year", "month", "day"))


def scan_parquet_day(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """One day of a day-partitioned folder."""
    return _days(spark, root, [day])


def scan_day_range(spark: SparkSession, root: str, first: dt.date,
                   last: dt.date) -> DataFrame:
    """Days first..last of a day-partitioned folder, as one read."""
    return _days(spark, root, [first + dt.timedelta(days=i)
                               for i in range((last - first).days + 1)])


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def scan_parquet_listing(spark: SparkSession, prefix: str) -> DataFrame | None:
    """Every ``*.parquet`` file under a prefix, at any depth; None when the
    prefix is missing or holds no such file."""
    try:
        df = (spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true")
              .option("recursiveFileLookup", "true").parquet(prefix))
    except AnalysisException:
        return None
    return df


def union_frames(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---- sinks ----------------------------------------------------------------------

def write_dlq(df: DataFrame, table: LakeTable, run_date: dt.date) -> int:
    """Replace this run date's dead letters for one source; returns the count.

    Partitioned by run date, so a rerun replaces its own rows, and one without
    bad rows clears them.
    """
    table.replace_partitions(df.withColumn("run_date", F.lit(run_date)), "run_date",
                             days=[run_date])
    return table.read().filter(F.col("run_date") == F.lit(run_date)).count()
