"""Database tables over JDBC."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from contrail.schemas import STATE, Table

# Columns whose newer value wins when a stored row is replaced; a row without the guard column is replaced outright.
_GUARD = {STATE.name: "last_event_time_utc"}
# Tables that note the time of a replacement, when asked to.
_STAMP = {STATE.name: "updated_at_utc"}


def scan_options(
    url: str, table: str, options: Mapping[str, object] | None = None, column: str | None = None,
    lower: object = None, upper: object = None, partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. With a split column and bounds the table is read by that many connections at once."""
    settings: dict[str, object] = {"url": url, "dbtable": table, "fetchsize": 10_000, **(options or {})}
    if column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a split scan needs column, lower, upper and partitions")
        settings.update(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return {key: str(value) for key, value in settings.items()}


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, options: Mapping[str, object] | None = None, **split: object,
) -> DataFrame:
    """A database table. Filters and column choice made on the result are sent to the database."""
    return spark.read.format("jdbc").options(**scan_options(url, table, options, **split)).load()


def merge_statement(table: Table, staging: str, replace: bool, stamp: bool = False) -> str:
    """Standard MERGE of a staging table into a table by its key.

    ``replace`` overwrites stored rows that are not newer, otherwise stored rows stay as they are. Both forms may be
    repeated with the same staging rows, which makes a replayed batch harmless.
    """
    on = " AND ".join(f"t.{k} = s.{k}" for k in table.key)
    names = ", ".join(table.columns)
    values = ", ".join(f"s.{c}" for c in table.columns)
    matched = ""
    if replace:
        guard = _GUARD.get(table.name)
        condition = (
            f" AND (t.{guard} IS NULL OR s.{guard} >= t.{guard})" if guard else ""
        )
        now = _STAMP.get(table.name) if stamp else None
        sets = ", ".join(
            f"{c} = " + ("CURRENT_TIMESTAMP" if c == now else f"s.{c}") for c in table.columns if c not in table.key
        )
        matched = f" WHEN MATCHED{condition} THEN UPDATE SET {sets}"
    return (
        f"MERGE INTO {table.name} t USING {staging} s ON ({on}){matched}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of one database. Executors write a staging table in parallel; the driver then sends one statement.

    The staging table carries run and batch, so a replayed batch overwrites its own leavings and no other query's.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_rows: int = 10_000
    # For large tables by name: column, lower, upper and partitions of a scan over several connections.
    splits: Mapping[str, Mapping[str, object]] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_jdbc_table(spark, self.url, name, self.properties, **self.splits.get(name, {}))

    def append(self, rows: DataFrame, table: Table, batch_id: int) -> None:
        self._merge(rows, table, batch_id, replace=False)

    def replace(self, rows: DataFrame, table: Table, batch_id: int) -> None:
        self._merge(rows, table, batch_id, replace=True)

    def upsert(self, rows: DataFrame, table: Table, batch_id: int, updated_at: str = "now") -> None:
        self._merge(rows, table, batch_id, replace=True, stamp=updated_at == "now")

    def _merge(self, rows: DataFrame, table: Table, batch_id: int, replace: bool, stamp: bool = False) -> None:
        from contrail.sources.tables import conform, run_id

        run = run_id(rows.sparkSession)
        mark = "" if run == "direct" else hashlib.md5(run.encode()).hexdigest()[:12] + "_"
        staging = f"{table.name}_stage_{mark}{batch_id}"
        (
            conform(rows, table).write.format("jdbc").mode("overwrite")
            .options(url=self.url, dbtable=staging, batchsize=self.batch_rows, **self.properties).save()
        )
        self._execute(rows.sparkSession, [merge_statement(table, staging, replace, stamp), f"DROP TABLE {staging}"])

    def _execute(self, spark: SparkSession, statements: list[str]) -> None:
        jvm = spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.executeUpdate(text)
            connection.commit()
        finally:
            connection.close()


