"""Latest row per vehicle, and the merges that keep keyed tables up to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contrail.operators.filters import with_key
from contrail.schemas import STATE


def to_state_rows(df: DataFrame) -> DataFrame:
    """Telemetry rows to the columns of the state table."""
    renamed = {
        "last_event_time_utc": F.col("event_ts"),
        "updated_at_utc": F.col("ingestion_ts"),
    }
    return df.select(*[renamed.get(name, F.col(name)).alias(name) for name in STATE.columns])


def _newest(columns: list[str], key: list[str], order: list[str]) -> Column:
    """Ordering struct: the given columns first, then all others, so that equal times are settled the same way
    whatever the order of the rows."""
    rest = sorted(c for c in columns if c not in key and c not in order)
    return F.struct(*order, *rest)


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key.

    One shuffle. ``max_by`` combines on the map side, so a key that holds a third of the rows leaves each map
    task as a single row.
    """
    values = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*values), _newest(df.columns, key, order)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, "_best.*").select(*df.columns)


def latest_state(df: DataFrame) -> DataFrame:
    """Telemetry rows to one state row per vehicle; rows without an id do not count."""
    rows = with_key(to_state_rows(df))
    return latest_per_key(rows, list(STATE.key), ["last_event_time_utc", "updated_at_utc"])


def merge_state(current: DataFrame, incoming: DataFrame, updated_at: str = "now") -> DataFrame:
    """State table after an upsert of ``incoming`` (state rows, possibly several per vehicle).

    A stored row gives way to one that is not older. ``updated_at="now"`` stamps rows that replace a stored row
    with the current time and leaves first inserts at their ingestion time; ``"incoming"`` takes the time as it
    comes. One shuffle for the whole merge: both sides enter the same aggregate.
    """
    if updated_at not in ("now", "incoming"):
        raise ValueError("updated_at is 'now' or 'incoming'")
    columns, key = STATE.columns, list(STATE.key)
    both = (
        current.select(*columns).withColumn("_new", F.lit(0))
        .unionByName(with_key(incoming.select(*columns)).withColumn("_new", F.lit(1)))
    )
    values = [c for c in columns if c not in key] + ["_new"]
    # Equal event times: a new row beats the stored one, whatever its other columns say.
    order = _newest(columns + ["_new"], key, ["last_event_time_utc", "_new", "updated_at_utc"])
    merged = both.groupBy(*key).agg(
        F.max_by(F.struct(*values), order).alias("_best"), F.min("_new").alias("_first"),
    )
    replaced = (F.col("_best._new") == 1) & (F.col("_first") == 0)
    stamp = F.when(replaced, F.current_timestamp()) if updated_at == "now" else F.lit(None).cast("timestamp")
    return merged.select(
        *[
            (F.coalesce(stamp, F.col("_best.updated_at_utc")) if c == "updated_at_utc"
             else F.col(c) if c in key else F.col(f"_best.{c}")).alias(c)
            for c in columns
        ]
    )


def absent_rows(new: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one per key.

    Repeats inside ``new`` are combined before the anti-join, so no key is hot when the join shuffles.
    """
    values = [c for c in new.columns if c not in key]
    one = new.groupBy(*key).agg(F.min(F.struct(*values)).alias("_row")).select(*key, "_row.*").select(*new.columns)
    return one.join(existing.select(*key), key, "left_anti")


def insert_if_absent(new: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """``existing``, which holds a key once, plus a row of ``new`` for each key it does not hold.

    Both sides enter one aggregate in which a stored row comes first, so each is read once and shuffled once.
    """
    columns = existing.columns
    values = F.struct("_new", *[c for c in columns if c not in key])
    both = existing.withColumn("_new", F.lit(1)).unionByName(new.select(*columns).withColumn("_new", F.lit(2)))
    return both.groupBy(*key).agg(F.min(values).alias("_row")).select(*key, "_row.*").select(*columns)
