"""Counters of the ingest step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from contrail.session import landed


def dlq_counts(dead: DataFrame) -> DataFrame:
    """Dead letters by error type."""
    return dead.groupBy("error_type").agg(F.count(F.lit(1)).alias("dead_letters"))


def running_total(df: DataFrame, order: str, value: str, into: str, block: int = 4096) -> DataFrame:
    """Sum of ``value`` over all rows up to and including this one in ``order``, a unique whole-number column.

    An unpartitioned window would put every row into one task. Here rows are summed in blocks of ``block``
    consecutive order values, blocks in super-blocks, and only the super-block totals meet in one task, one row
    per ``block ** 2`` order values. Reads ``df`` three times.
    """
    def prefix(rows: DataFrame, within: list[str], by: str, amount: str, name: str, inclusive: bool) -> DataFrame:
        end = 0 if inclusive else -1
        window = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, end)
        return rows.withColumn(name, F.coalesce(F.sum(amount).over(window), F.lit(0)))

    rows = df.withColumn("_b", F.floor(F.col(order) / block))
    blocks = rows.groupBy("_b").agg(F.sum(value).alias("_bv")).withColumn("_s", F.floor(F.col("_b") / block))
    supers = blocks.groupBy("_s").agg(F.sum("_bv").alias("_sv")).withColumn("_all", F.lit(0))

    supers = prefix(supers, ["_all"], "_s", "_sv", "_s0", inclusive=False).select("_s", "_s0")
    blocks = prefix(blocks, ["_s"], "_b", "_bv", "_b0", inclusive=False).join(supers, "_s")
    blocks = blocks.select("_b", (F.col("_b0") + F.col("_s0")).alias("_before"))
    inside = prefix(rows, ["_b"], order, value, "_inside", inclusive=True)
    return inside.join(blocks, "_b").withColumn(into, F.col("_before") + F.col("_inside")).select(*df.columns, into)


def poll_counters(normalized: DataFrame, passed: DataFrame, poll: str = "poll_id") -> DataFrame:
    """Per poll: vectors, sent, dead letters, repeats skipped, altitudes suppressed.

    ``normalized`` is the output of ``normalize_vectors``, ``passed`` the valid events that went on after
    de-duplication; both carry the poll.
    """
    seen = normalized.groupBy(poll).agg(
        F.count(F.lit(1)).alias("states"),
        F.count_if(F.col("dead").isNotNull()).alias("dlq"),
        F.count_if("altitude_suppressed").alias("altitudes_suppressed"),
    )
    sent = passed.groupBy(poll).agg(F.count(F.lit(1)).alias("sent"))
    return (
        seen.join(sent, poll, "left")
        .withColumn("sent", F.coalesce("sent", F.lit(0)))
        .withColumn("dedupe_skipped", F.col("states") - F.col("dlq") - F.col("sent"))
    )


def ingest_counters(normalized: DataFrame, passed: DataFrame, poll: str = "poll_id") -> DataFrame:
    """``poll_counters`` and all skips so far. The per-poll rows are written once, as the running total reads them
    thrice."""
    polls = poll_counters(normalized, passed, poll)
    return running_total(landed(polls, "polls"), poll, "dedupe_skipped", "total_skipped")


def observe_ingest(normalized: DataFrame, name: str = "ingest") -> DataFrame:
    """Same counters as metrics of a running query, reported with its progress."""
    return normalized.observe(
        name,
        F.count(F.lit(1)).alias("states"),
        F.count_if(F.col("dead").isNotNull()).alias("dlq"),
        F.count_if("altitude_suppressed").alias("altitudes_suppressed"),
    )
