"""Tables kept as parquet folders: snapshots, batch-wise window tables and versioned keyed tables."""

from __future__ import annotations

import datetime
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contrail.operators.latest import latest_per_key, merge_state
from contrail.operators.views import latest_window
from contrail.schemas import BY_NAME, Table
from contrail.sources.jdbc import JdbcTarget


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns in its types. Counts become INT only here; whole numbers in the place of a time are
    nanoseconds, as some writers of snapshots store them."""
    found = dict(df.dtypes)

    def column(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType) and found[field.name] == "bigint":
            value = F.timestamp_micros(F.floor(value / 1000))
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in table.schema])


def read_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet``. A missing path fails at once with PATH_NOT_FOUND."""
    path = f"{base}/{name}.parquet"
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if "TIMESTAMP(NANOS" not in str(error):
            raise
        # Only such files need this setting, which holds for the session from then on, as it also counts when rows are
        # read; see ``conform``.
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        found = spark.read.parquet(path)
    return conform(found, BY_NAME[name]) if name in BY_NAME else found


def write_snapshot(df: DataFrame, base: str, name: str) -> str:
    path = f"{base}/{name}.parquet"
    (conform(df, BY_NAME[name]) if name in BY_NAME else df).write.mode("overwrite").parquet(path)
    return path


def export_snapshots(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write each table to its snapshot, replacing the previous one. A failing read fails the export."""
    return {name: write_snapshot(df, base, name) for name, df in tables.items()}


def load_table(
    spark: SparkSession, name: str, mode: str, base: str | None = None, database: JdbcTarget | None = None,
) -> DataFrame:
    """A table from its snapshot or from the database, chosen by ``mode`` at call time."""
    if mode == "snapshot":
        return read_snapshot(spark, base, name)
    if mode == "postgres":
        return database.read(spark, name)
    raise ValueError("mode is 'snapshot' or 'postgres'")


PARTS = ("window_date date", "run string", "batch bigint")


def ensure_table(spark: SparkSession, table: Table, path: str, database: str | None = None) -> None:
    """Create the catalog table over ``path`` unless it exists, laid out as ``FolderTarget`` writes window tables."""
    name = f"{database}.{table.name}" if database else table.name
    columns = [f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in table.schema]
    partitioned = ""
    if table.window:
        columns += PARTS
        partitioned = f" PARTITIONED BY ({', '.join(p.split()[0] for p in PARTS)})"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet{partitioned} LOCATION '{path}'"
    )


def run_id(spark: SparkSession) -> str:
    """Which run a batch belongs to: the id of the streaming query, which a new checkpoint changes and a restart does
    not; ``direct`` where a writer is called outside of a query."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


@dataclass(frozen=True, order=True)
class Version:
    """A whole copy of a keyed table, and the batch that wrote it."""

    number: int
    run: str
    batch: int

    @property
    def folder(self) -> str:
        return f"v={self.number}+{self.run}+{self.batch}"


@dataclass(frozen=True)
class FolderTarget:
    """Tables below one shared folder.

    Window tables are split by window date, run and batch, in this order; a replayed batch overwrites its own folders,
    and a query with a new checkpoint, whose batches are numbered anew, is another run. ``compact`` puts the folders
    of closed days together. Keyed tables are whole versions, numbered on over all runs; a version counts once its
    success marker is there, so a reader never sees a half-written one, and a replayed batch starts from the version
    before its own. Versions are kept for ``keep_hours``, which must be longer than any read takes, and the newest two
    whatever their age.
    """

    base: str
    keep_hours: float = 24.0

    def path(self, table: Table | str) -> str:
        return f"{self.base}/{table if isinstance(table, str) else table.name}"

    # window tables

    def append(self, rows: DataFrame, table: Table, batch_id: int) -> None:
        placed = conform(rows, table).withColumns({
            "window_date": F.to_date(F.col(table.window)), "run": F.lit(run_id(rows.sparkSession)),
            "batch": F.lit(batch_id).cast("bigint"),
        })
        self._write_parts(placed, table)

    replace = append

    def _write_parts(self, placed: DataFrame, table: Table) -> None:
        (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*[p.split()[0] for p in PARTS]).parquet(self.path(table)))

    def _parts(self, spark: SparkSession, table: Table) -> DataFrame:
        """The rows of a window table with their date, run, batch and time of writing; none before the first write."""
        schema = T.StructType([*table.schema.fields, T.StructField("window_date", T.DateType()),
                               T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])
        files, jvm_path = self._files(spark, table)
        if not files.exists(jvm_path(self.path(table))):
            return spark.createDataFrame([], schema.add("_written", T.TimestampType()))
        rows = spark.read.schema(schema).parquet(self.path(table))
        return rows.withColumn("_written", F.col("_metadata.file_modification_time"))

    def windows(
        self, spark: SparkSession, table: Table, newest: bool = False, since: datetime.date | None = None,
        other_than: int | None = None,
    ) -> DataFrame:
        """A window table. ``newest`` settles windows that several batches emitted on the last emission; ``since``
        reads the folders of that date and later only; ``other_than`` leaves out what this batch of the current run,
        and any after it, has written."""
        rows = self._parts(spark, table)
        if since is not None:
            rows = rows.where(F.col("window_date") >= F.lit(since))
        if other_than is not None:
            rows = rows.where((F.col("run") != run_id(spark)) | (F.col("batch") < other_than))
        if newest:
            # Emissions of different runs are told apart by the time they were written.
            rows = latest_per_key(rows.drop("window_date", "run"), list(table.key), ["_written", "batch"])
        return conform(rows, table)

    def newest_date(self, spark: SparkSession, table: Table) -> datetime.date | None:
        """The last date that a window table has rows of, from the names of its folders: no file is opened."""
        files, jvm_path = self._files(spark, table)
        place = jvm_path(self.path(table))
        if not files.exists(place):
            return None
        names = [status.getPath().getName() for status in files.listStatus(place)]
        days = [n.removeprefix("window_date=") for n in names if n.startswith("window_date=")]
        return max((datetime.date.fromisoformat(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__"), default=None)

    def newest_window(self, spark: SparkSession, table: Table, end: str = "window_end") -> DataFrame:
        """The rows of the newest window; only the last date is read. Windows lie within the date of their start, so of
        windows of equal length the newest begins on the last date."""
        since = self.newest_date(spark, table)
        rows = self.windows(spark, table, newest=True, since=since)
        return latest_window(rows, end)

    def compact(self, spark: SparkSession, table: Table, before: datetime.date) -> None:
        """Put all folders of a day together, for days before ``before`` that no query writes any more.

        Windows that were emitted several times are settled on the last emission. The compacted rows are moved into
        place as a whole before anything else goes, so wherever this stops no row is lost: readers that settle windows
        (``read``) see the same rows at every moment, and the next call finishes what was left.
        """
        parts = self._parts(spark, table)
        days = [r[0] for r in parts.where(F.col("window_date") < F.lit(before)).groupBy("window_date").agg(
            F.countDistinct("run", "batch").alias("n")).where("n > 1").collect()]
        for day in days:
            self._clear(spark, table, day, self._place_compacted(spark, table, day))

    def _place_compacted(self, spark: SparkSession, table: Table, day: datetime.date) -> str:
        """Add the settled rows of a day to it; returns the name of their folder."""
        files, jvm_path = self._files(spark, table)
        rows = self.windows(spark, table, newest=True, since=day).where(F.to_date(F.col(table.window)) == F.lit(day))
        name = f"run=compacted-{uuid.uuid4().hex}"
        staged = f"{self.path(table)}/_{name}"
        rows.write.parquet(f"{staged}/batch=0")
        if not files.rename(jvm_path(staged), jvm_path(f"{self.path(table)}/window_date={day}/{name}")):
            raise OSError(f"{staged} could not be moved into place")
        return name

    def _clear(self, spark: SparkSession, table: Table, day: datetime.date, keep: str) -> None:
        """Remove all folders of a day but one."""
        files, jvm_path = self._files(spark, table)
        for status in files.listStatus(jvm_path(f"{self.path(table)}/window_date={day}")):
            if status.getPath().getName() != keep:
                files.delete(status.getPath(), True)

    def publish(self, spark: SparkSession, table: Table, database: str | None = None) -> None:
        """Make what lies in the folder readable under the table's name, in ``database`` or the current one: a window
        table with all its folders, a keyed one as a view of its newest version. To be called again after writes."""
        name = f"{database}.{table.name}" if database else table.name
        if table.window:
            ensure_table(spark, table, self.path(table), database)
            spark.sql(f"MSCK REPAIR TABLE {name}")
            spark.catalog.refreshTable(name)
        elif found := self.versions(spark, table):
            columns = ", ".join(table.columns)
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM "
                      f"parquet.`{self.path(table)}/{found[-1].folder}`")

    # keyed tables

    def upsert(self, rows: DataFrame, table: Table, batch_id: int, updated_at: str = "now") -> None:
        spark = rows.sparkSession
        current = self.keyed(spark, table, before=batch_id)
        if current is None:
            current = spark.createDataFrame([], table.schema)
        self.write_version(merge_state(current, rows, updated_at), table, batch_id)

    def write_version(self, rows: DataFrame, table: Table | str, batch_id: int) -> None:
        spark = rows.sparkSession
        version = self._version_of(spark, table, batch_id)
        rows.write.mode("overwrite").parquet(f"{self.path(table)}/{version.folder}")
        self._expire(spark, table)

    def keyed(self, spark: SparkSession, table: Table | str, before: int | None = None) -> DataFrame | None:
        """The newest complete version, or the one a batch of the current run starts from; None if there is none."""
        versions = self.versions(spark, table)
        if before is not None:
            own = self._version_of(spark, table, before)
            versions = [v for v in versions if v.number < own.number]
        if not versions:
            return None
        rows = spark.read.parquet(f"{self.path(table)}/{versions[-1].folder}")
        return conform(rows, table) if isinstance(table, Table) else rows

    def _version_of(self, spark: SparkSession, table: Table | str, batch_id: int) -> Version:
        """The version of a batch: its own if it has been written before, else a new one after all others."""
        run, found = run_id(spark), self.versions(spark, table)
        own = [v for v in found if (v.run, v.batch) == (run, batch_id)]
        return own[-1] if own else Version(found[-1].number + 1 if found else 0, run, batch_id)

    def versions(self, spark: SparkSession, table: Table | str) -> list[Version]:
        """The complete versions, oldest first."""
        files, jvm_path = self._files(spark, table)
        if not files.exists(jvm_path(self.path(table))):
            return []
        found = []
        for status in files.listStatus(jvm_path(self.path(table))):
            name = status.getPath().getName()
            if name.startswith("v=") and files.exists(jvm_path(f"{self.path(table)}/{name}/_SUCCESS")):
                number, run, batch = name[2:].split("+")
                found.append(Version(int(number), run, int(batch)))
        return sorted(found)

    def _expire(self, spark: SparkSession, table: Table | str) -> None:
        files, jvm_path = self._files(spark, table)
        limit = (time.time() - self.keep_hours * 3600) * 1000
        for version in self.versions(spark, table)[:-2]:
            folder = jvm_path(f"{self.path(table)}/{version.folder}")
            if files.getFileStatus(folder).getModificationTime() <= limit:
                files.delete(folder, True)

    def drop(self, spark: SparkSession, path: str) -> None:
        """Remove a folder below the base."""
        files, jvm_path = self._files(spark, path)
        files.delete(jvm_path(self.path(path)), True)

    def _files(self, spark: SparkSession, table: Table | str):
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        files = path(self.path(table)).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        return files, path

    def read(self, spark: SparkSession, name: str, other_than: int | None = None,
             since: datetime.date | None = None) -> DataFrame:
        """A table by name, one row for each key. ``other_than`` and ``since`` as in ``windows``."""
        table = BY_NAME[name]
        if table.window:
            return self.windows(spark, table, newest=True, since=since, other_than=other_than)
        rows = self.keyed(spark, table)
        return spark.createDataFrame([], table.schema) if rows is None else rows
