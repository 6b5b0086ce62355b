"""A keyed table in hash buckets: a base and a delta of what came since, merged when it is read.

A batch is merged into the delta and leaves the base alone, so it costs what has come since the last base, whatever the
size of the table. Base and delta are bucketed alike by the key: merging them joins bucket with bucket and moves no stored
row; only the rows of the batch are shuffled. From time to time ``compact`` makes both a new base.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail.operators.filters import with_key
from contrail.operators.latest import latest_per_key
from contrail.schemas import STATE, Table
from contrail.sources.tables import FolderTarget, conform, run_id

BASE, DELTA, STAMP = "base", "delta", "written_at"


@dataclass(frozen=True, order=True)
class Part:
    """A base, which holds everything up to its number, or a delta: all since the base before, up to a batch."""

    number: int
    kind: str
    run: str
    batch: int

    @property
    def folder(self) -> str:
        return f"{self.kind}+{self.number}+{self.run}+{self.batch}"


@dataclass(frozen=True)
class BucketedTarget:
    """Keyed tables below one shared folder, in ``buckets`` buckets each.

    ``order`` are the columns by which the newest row of a key is known; a stored row gives way to one that is not older.
    Parts are declared in the session's catalog, in ``database``, as bucketed tables over their folders, and a part
    counts once its success marker is there. A batch that runs again starts from the parts before its own. Parts that a
    newer one has made superfluous are kept for ``keep_hours``, which must be longer than any read takes.
    """

    base: str
    buckets: int = 256
    order: tuple[str, ...] = ("last_event_time_utc",)
    database: str = "default"
    keep_hours: float = 24.0

    def _folder(self, table: Table, part: Part) -> str:
        return f"{self.base}/{table.name}/{part.folder}"

    def _declared(self, table: Table, part: Part) -> str:
        mark = hashlib.md5(self._folder(table, part).encode()).hexdigest()
        return f"{self.database}.{table.name}_{part.kind}_{mark}"

    def parts(self, spark: SparkSession, table: Table) -> list[Part]:
        """All complete parts, oldest first."""
        files, path = FolderTarget(self.base)._files(spark, table)
        place = path(f"{self.base}/{table.name}")
        if not files.exists(place):
            return []
        found = []
        for status in files.listStatus(place):
            kind, number, run, batch = status.getPath().getName().split("+")
            if files.exists(path(f"{status.getPath()}/_SUCCESS")):
                found.append(Part(int(number), kind, run, int(batch)))
        return sorted(found)

    def current(self, spark: SparkSession, table: Table, before: int | None = None) -> list[Part]:
        """The newest base and the newest delta after it, as far as there are any, with numbers below ``before``."""
        every = [p for p in self.parts(spark, table) if before is None or p.number < before]
        bases = [p for p in every if p.kind == BASE][-1:]
        after = bases[0].number if bases else -1
        return bases + [p for p in every if p.kind == DELTA and p.number > after][-1:]

    # writing

    def upsert(self, rows: DataFrame, table: Table, batch_id: int, updated_at: str = "now") -> None:
        """Add a batch of rows, possibly several for each key. ``updated_at`` as in ``operators.merge_state``."""
        if updated_at not in ("now", "incoming"):
            raise ValueError("updated_at is 'now' or 'incoming'")
        spark, run = rows.sparkSession, run_id(rows.sparkSession)
        every = self.parts(spark, table)
        own = [p for p in every if (p.kind, p.run, p.batch) == (DELTA, run, batch_id)]
        number = own[-1].number if own else every[-1].number + 1 if every else 0
        rest = [c for c in ("updated_at_utc",) if c in table.columns]
        newest = latest_per_key(with_key(conform(rows, table), table.key[0]), list(table.key), [*self.order, *rest])
        stamp = F.current_timestamp() if updated_at == "now" else F.lit(None).cast("timestamp")
        batch = newest.withColumn(STAMP, stamp).repartition(self.buckets, *table.key)
        stored = [p for p in self.current(spark, table, before=number) if p.kind == DELTA]
        merged = self._merged(table, self._part(spark, table, stored[0]), batch) if stored else batch
        self._write(merged, table, Part(number, DELTA, run, batch_id))
        self._expire(spark, table)

    def _write(self, rows: DataFrame, table: Table, part: Part) -> None:
        """Rows are dealt as the buckets are, so there is one file for each."""
        name, key = self._declared(table, part), list(table.key)
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        (rows.write.mode("overwrite").format("parquet").bucketBy(self.buckets, *key)
         .sortBy(*key).option("path", self._folder(table, part)).saveAsTable(name))

    def compact(self, spark: SparkSession, table: Table, least: int = 8) -> bool:
        """Make a new base of what there is, if ``least`` batches or more have come since the last one. Readers go on
        with the parts they began with; no batch may be written meanwhile."""
        parts = self.current(spark, table)
        since = parts[-1].number - (parts[0].number if parts[0].kind == BASE else -1) if parts else 0
        if since < max(1, least):
            return False
        self._write(self._rows(spark, table, parts), table, Part(parts[-1].number, BASE, "compacted", 0))
        self._expire(spark, table)
        return True

    def _expire(self, spark: SparkSession, table: Table) -> None:
        files, path = FolderTarget(self.base)._files(spark, table)
        limit = (time.time() - self.keep_hours * 3600) * 1000
        needed = self.current(spark, table)
        for part in self.parts(spark, table):
            place = path(self._folder(table, part))
            if part not in needed and files.getFileStatus(place).getModificationTime() <= limit:
                files.delete(place, True)

    # reading

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        """One row for each key."""
        parts = self.current(spark, table)
        if not parts:
            return spark.createDataFrame([], table.schema)
        return conform(self._rows(spark, table, parts), table)

    def _rows(self, spark: SparkSession, table: Table, parts: list[Part]) -> DataFrame:
        stored = [self._part(spark, table, p) for p in parts]
        return stored[0] if len(stored) == 1 else self._merged(table, *stored)

    def _part(self, spark: SparkSession, table: Table, part: Part) -> DataFrame:
        name, key = self._declared(table, part), ", ".join(table.key)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {STAMP} timestamp) USING parquet CLUSTERED BY ({key}) "
                  f"SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self._folder(table, part)}'")
        return spark.table(name)

    def _merged(self, table: Table, stored: DataFrame, later: DataFrame) -> DataFrame:
        """Bucket joined with bucket: no exchange."""
        key, values = list(table.key), [c for c in table.columns if c not in table.key] + [STAMP]
        old = stored.select(*key, F.struct(*values).alias("old"))
        new = later.select(*key, F.struct(*values).alias("new"))
        newest = self._newer(F.col("old"), F.col("new"), values)
        rows = old.join(new, key, "full").select(*key, newest.alias("row"))
        return rows.select(*[F.col(c) if c in key else F.col(f"row.{c}") for c in [*table.columns, STAMP]])

    def _newer(self, old: Column, new: Column, values: list[str]) -> Column:
        """The row that stays of a stored one and a later batch's. One that takes another's place has the time of its
        writing, where batches are stamped, as the time of its update."""
        updated = {"updated_at_utc": F.coalesce(new[STAMP], new["updated_at_utc"])} if "updated_at_utc" in values else {}
        replaced = F.struct(*[updated.get(c, new[c]).alias(c) for c in values])

        def before(c: str) -> Column:
            return F.coalesce(new[c] < old[c], new[c].isNull() & old[c].isNotNull())

        older = reduce(lambda rest, c: before(c) | (new[c].eqNullSafe(old[c]) & rest), reversed(self.order), F.lit(False))
        return F.when(new.isNull(), old).when(old.isNull(), new).when(older, old).otherwise(replaced)
