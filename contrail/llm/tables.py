"""Intermediate tables of the text operators."""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import session
from contrail.llm.text import unused

# Bits of the map that tells rows whether their ids are listed: at most 2^18 rows of 64 are broadcast.
MARKS = 1 << 24

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_open = threading.local()


@contextlib.contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def landed(df: DataFrame, purpose: str, batch_mb: int | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and read it from there. Its shuffle files are freed once it is written:
    whoever needs the rows again reads the table. ``batch_mb`` bounds the batches that Python workers get, for rows
    that are large or become so."""
    spark = df.sparkSession
    path = session.work_dir(spark, purpose)
    with _set(spark, {_FREE: "true", **({_BATCH: f"{batch_mb}m"} if batch_mb else {})}):
        df.write.parquet(path)
    for paths in getattr(_open, "scopes", []):
        paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._landed = path
    return out


def settled(build: Callable[[], DataFrame], purpose: str, batch_mb: int | None = None) -> DataFrame:
    """What ``build`` returns, landed; then the tables that were landed on the way are removed.

    They are removed when the result stands, so a lost executor finds what its tasks read. Only what ``build`` lands
    itself goes: tables that it was given stay.
    """
    scopes = _open.__dict__.setdefault("scopes", [])
    paths: list[str] = []
    scopes.append(paths)
    try:
        built = build()
        on_the_way = list(paths)
        out = landed(built, purpose, batch_mb)
    finally:
        scopes.pop()
    remove(out.sparkSession, on_the_way)
    for outer in scopes:
        outer[:] = [p for p in outer if p not in set(on_the_way)]
    return out


def remove(spark: SparkSession, paths: list[str]) -> None:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        place = jvm_path(path)
        place.getFileSystem(conf).delete(place, True)


def place_of(table: DataFrame) -> str:
    """The folder of a table that ``landed`` returned, before anything is selected from it."""
    return table._landed


def marked(rows: DataFrame, column: str, ids: DataFrame, listed: str, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false where the column is surely not among the ``listed`` of ``ids``, found without moving
    any row. A bit map of ``MARKS`` bits is sent to them. It is of that size whatever there is to mark; the fuller it is,
    the more rows are flagged that are not listed. Null is an id like others."""
    bit = F.pmod(F.xxhash64(F.col(f"`{listed}`")), F.lit(MARKS))
    words = landed(ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("marks")), "listed-marks")
    own, word, marks = unused("bit", rows), unused("word", rows), unused("marks", rows)
    held = rows.withColumn(own, F.pmod(F.xxhash64(F.col(f"`{column}`")), F.lit(MARKS))).withColumn(
        word, F.shiftright(own, 6)).join(F.broadcast(words.toDF(word, marks)), word, "left")
    listed_bit = F.getbit(F.col(marks), F.pmod(F.col(own), F.lit(64)).cast("int")) == 1
    return held.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(listed_bit, F.lit(False)).alias(flag))
