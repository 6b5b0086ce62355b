"""Removal of repeats within a time-to-live.

A row passes if no row of the same key passed within the last ``ttl`` clock units; a rejected row does not extend
the life of the one that passed. The decision runs along the time line of a key: with a TTL of 120, clocks 0, 60,
119, 120, 200, 241 keep 0, 120 and 241. Null key parts are equal to each other.

One key may hold any share of the rows, so its time line is never handled as a whole:

1. Rows with equal key and clock are cut to one. This spreads a hot key over its distinct clock values, and the
   group limit in front of the shuffle already drops most repeats.
2. The time line is cut into slots of ``span`` clock units. Each (key, slot) is decided on its own, so a task holds
   at most ``span`` rows of one key at a time.
3. Slots depend on each other only where a row in the first ``ttl`` units of a slot follows a row in the last
   ``ttl`` units of the slot before. For those slots, and only those, a table of "first row accepted -> last row
   accepted" is worked out per slot; walking these small tables in order gives each slot the acceptance it
   inherits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.schemas import DEDUPE_KEYS, DEDUPE_TTL_SECONDS

DAY = 86_400
PIECE = 500


def clock_seconds(ts: Column) -> Column:
    """Whole epoch seconds, the precision that ingestion times have on the wire."""
    return F.unix_timestamp(ts)


def dedupe_ttl(
    df: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, ttl: int = DEDUPE_TTL_SECONDS, clock: str = "clock_s",
    tiebreak: Sequence[str] = (), seen: DataFrame | None = None, span: int = DAY,
) -> DataFrame:
    """Rows of ``df`` that pass. ``clock`` is an integer column, ``ttl`` and ``span`` are in its unit.

    Of rows with equal key and clock the first by ``tiebreak`` is taken (by all other columns if none is given).
    ``seen`` holds earlier acceptances as (keys, clock) rows, at most one per key; see ``accepted_last``.
    ``df`` is read up to three times, twice for keys and clock only: write it out first if it is costly to make.
    """
    if ttl <= 0:
        return df
    span = max(span, ttl)
    columns = df.columns
    carried = [c for c in columns if c not in keys]
    tiebreak = list(tiebreak) or [c for c in carried if c != clock]
    at = F.col(clock).cast("long")
    keyed = df.where(F.col(clock).isNotNull()).select(
        _key(keys).alias("_k"), _slot(at, span).alias("_slot"), at.alias("_t"), F.lit(False).alias("_old"),
        F.struct(*carried).alias("_row"),
    )
    if seen is not None:
        # An earlier acceptance takes its place in the time line like a row, and is left out at the end.
        past = seen.select(_key(keys).alias("_k"), F.col(clock).cast("long").alias("_t")).select(
            "_k", _slot(F.col("_t"), span).alias("_slot"), "_t", F.lit(True).alias("_old"))
        keyed = keyed.unionByName(past, allowMissingColumns=True)
    rows = _first_per_instant(keyed, tiebreak)

    # Repeats make no difference to what slots inherit, so this reads keys and clocks straight from the input, and
    # instants are combined in the tasks before anything else.
    inherited = _inherited(keyed.select("_k", "_slot", "_t").distinct(), ttl, span)
    # What a slot inherits travels with its rows, so this is one shuffle and no join.
    both = rows.select("_k", "_slot", F.struct("_t", "_old", "_row").alias("_at"),
                       F.lit(None).cast("long").alias("_last"))
    both = both.unionByName(inherited.select("_k", "_slot", "_last"), allowMissingColumns=True)
    by_slot = both.groupBy("_k", "_slot").agg(
        F.array_sort(F.collect_list("_at")).alias("_rows"), F.max("_last").alias("_last")
    )
    passed = by_slot.select("_k", F.explode(_walk(F.col("_rows"), F.col("_last"), ttl)).alias("_passed"))
    return passed.where(~F.col("_passed._old")).select(
        *[F.col(f"_k.{c}" if c in keys else f"_passed._row.{c}") for c in columns])


def _slot(at: Column, span: int) -> Column:
    """Number of the slot; rounds down below zero too."""
    return ((at - F.pmod(at, F.lit(span))) / F.lit(span)).cast("long")


def _key(keys: Sequence[str]) -> Column:
    """The key as one struct: never null itself, and equal where all parts are equal or both null."""
    return F.struct(*keys)


def _first_per_instant(keyed: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    order = Window.partitionBy("_k", "_slot", "_t").orderBy(
        F.desc("_old"), *[F.col(f"_row.{c}").asc_nulls_last() for c in tiebreak]
    )
    return keyed.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def _inherited(instants: DataFrame, ttl: int, span: int) -> DataFrame:
    """(key, slot, last acceptance before the slot) for the slots where it matters."""
    into_slot = F.col("_t") - F.col("_slot") * span
    head, tail = into_slot < ttl, into_slot >= span - ttl

    # Slot borders with rows close on both sides. Only rows near a border are read for this.
    borders = instants.where(head | tail).select(
        "_k", "_t",
        F.explode(F.array_compact(F.array(
            F.when(head, F.struct(F.col("_slot").alias("at"), F.lit(True).alias("after"))),
            F.when(tail, F.struct((F.col("_slot") + 1).alias("at"), F.lit(False).alias("after"))),
        ))).alias("_b"),
    )
    linked = (
        borders.groupBy("_k", F.col("_b.at").alias("_at"))
        .agg(F.min(F.when(F.col("_b.after"), F.col("_t"))).alias("_next"),
             F.max(F.when(~F.col("_b.after"), F.col("_t"))).alias("_prev"))
        .where(F.col("_next") < F.col("_prev") + ttl)
    )
    involved = linked.select("_k", F.explode(F.array(F.col("_at") - 1, F.col("_at"))).alias("_slot")).distinct()

    # What each involved slot does with any acceptance it may inherit.
    slots = (
        instants.join(involved, ["_k", "_slot"], "left_semi")
        .groupBy("_k", "_slot").agg(F.array_sort(F.collect_set("_t")).alias("_ts"))
        .withColumn("_outcomes", _outcomes(F.col("_ts"), F.col("_slot") * span + ttl, ttl))
        .select("_k", "_slot", "_outcomes")
    )
    # At most one row per slot of the key's time span, and at most ttl outcomes in each.
    chain = slots.groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("_slot", "_outcomes"))).alias("_chain"))
    return chain.select("_k", F.inline(_hand_down(F.col("_chain"), ttl))).where(F.col("_last").isNotNull())


def _outcomes(ts: Column, head_end: Column, ttl: int) -> Column:
    """For each row that could be the first one accepted in the slot: (that row, last row accepted).

    The walks from all these rows go along together. Walks that have met stay together, so after every piece of the
    time line those at the same row are followed as one.
    """
    beyond = F.filter(ts, lambda t: t >= head_end)
    starts = F.concat(F.filter(ts, lambda t: t < head_end), F.slice(beyond, 1, 1))
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(ts) - 1) / PIECE).cast("int")),
                         lambda i: F.slice(ts, i * PIECE + 1, F.lit(PIECE)))

    def along(piece: Column, at: Column) -> Column:
        return F.aggregate(
            piece, at, lambda rows, t: F.transform(rows, lambda row: F.when(t >= row + ttl, t).otherwise(row))
        )

    def step(acc: Column, piece: Column) -> Column:
        return _let(along(piece, acc["at"]), lambda at: _let(F.array_distinct(at), lambda met: F.struct(
            F.transform(acc["walk"], lambda w: F.array_position(met, F.element_at(at, w.cast("int")))).alias("walk"),
            met.alias("at"),
        )))

    def outcome(start: Column, i: Column, end: Column) -> Column:
        walk = F.element_at(end["walk"], i + 1).cast("int")
        return F.struct(start.alias("first"), F.element_at(end["at"], walk).alias("last"))

    together = F.struct(
        F.sequence(F.lit(1).cast("bigint"), F.size(starts).cast("bigint")).alias("walk"), starts.alias("at")
    )
    return F.aggregate(
        pieces, together, step, lambda end: F.transform(starts, lambda start, i: outcome(start, i, end))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hand_down(chain: Column, ttl: int) -> Column:
    """Walk the slots of a key in order; array of (slot, acceptance inherited by the slot)."""
    start = F.struct(
        F.array().cast("array<struct<_slot: bigint, _last: bigint>>").alias("done"),
        F.lit(None).cast("bigint").alias("slot"), F.lit(None).cast("bigint").alias("last"),
    )

    def step(acc: Column, link: Column) -> Column:
        inherited = F.when(acc["slot"] == link["_slot"] - 1, acc["last"])
        first = F.element_at(
            F.concat(
                F.filter(link["_outcomes"], lambda o: inherited.isNull() | (o["first"] >= inherited + ttl)),
                F.array(F.struct(F.lit(None).cast("bigint").alias("first"), inherited.alias("last"))),
            ),
            1,
        )
        return F.struct(
            F.concat(acc["done"], F.array(F.struct(link["_slot"].alias("_slot"), inherited.alias("_last")))).alias(
                "done"
            ),
            link["_slot"].alias("slot"), first["last"].alias("last"),
        )

    return F.aggregate(chain, start, step, lambda acc: acc["done"])


def _walk(rows: Column, last: Column, ttl: int) -> Column:
    """The accepted ones of a slot's rows, which are in clock order."""
    start = F.struct(F.slice(rows, 1, 0).alias("kept"), last.cast("bigint").alias("last"))

    def step(acc: Column, row: Column) -> Column:
        passes = acc["last"].isNull() | (row["_t"] >= acc["last"] + ttl)
        return F.when(
            passes, F.struct(F.concat(acc["kept"], F.array(row)).alias("kept"), row["_t"].alias("last"))
        ).otherwise(acc)

    return F.aggregate(rows, start, step, lambda acc: acc["kept"])


def accepted_last(
    passed: DataFrame, seen: DataFrame | None, keys: Sequence[str], ttl: int, clock: str, now: int | None = None,
) -> DataFrame:
    """The ``seen`` table after a batch: last acceptance per key, without those that have expired at ``now``.

    Its size is the number of keys accepted within one TTL, not the number ever seen.
    """
    every = passed.select(*keys, F.col(clock).cast("long").alias(clock))
    if seen is not None:
        every = every.unionByName(seen.select(*keys, clock))
    alive = every if now is None else every.where(F.col(clock) > now - ttl)
    return alive.groupBy(*keys).agg(F.max(clock).alias(clock))


def dedupe_within_watermark(
    df: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, ttl: int = DEDUPE_TTL_SECONDS, time: str = "ingestion_ts",
) -> DataFrame:
    """Streaming only: the engine's own expiry. A key is held at least ``ttl`` seconds behind the newest time, and
    until the watermark next moves, so repeats that come a little after the TTL may go too. All rows of a key meet in
    one task; where keys may be hot, or the TTL has to be exact, use ``streaming.dedupe_stream``."""
    return df.withWatermark(time, f"{ttl} seconds").dropDuplicatesWithinWatermark(list(keys))
