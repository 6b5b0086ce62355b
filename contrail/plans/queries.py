"""The registered queries: (session, data folder) -> DataFrame, each over its whole input.

Timestamps leave as zone-less timestamps and averages rounded to six digits, so that results compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from contrail.functions import bbox_id
from contrail.operators import (
    airspace_density, airspace_grid_5m, clock_seconds, dedupe_ttl, dlq_counts,
    explode_state_vectors, ingest_counters, insert_if_absent, latest_state, live_kpis, live_positions,
    normalize_vectors, parse_events, parse_readings, quality_headline, quality_history, route_events,
    telemetry_quality_5m, to_dead_letter_messages, to_event_messages, to_imperial, to_state_rows, top_k, traffic_5m,
    traffic_hourly, vector_fields, vector_from_text, with_event_text, with_position, within_bbox,
)
from contrail.plans import projections as P
from contrail.schemas import (
    DEDUPE_KEYS, GRID_5M, QUALITY_5M, SCHEMA_VERSION, STATE, TELEMETRY, TRAFFIC_1H, TRAFFIC_5M, Table,
)
from contrail.session import configure, landed, work_dir
from contrail.sources import (
    BucketedTarget, FolderTarget, export_snapshots as write_snapshots, load_table, read_event_stream, within_bbox_stored,
    write_positions,
)
from contrail.streaming import (
    ProgressLog, QueryFailed, append_windows, await_queries, dedupe_stateful as dedupe_keyed,
    dedupe_stream as dedupe_batches, insert_absent_windows, keep_live, live_changes, read_ingest_counts, read_live,
    start_ingest, start_pipeline, start_shared_pipeline, start_traffic,
)

BOX = (25.0, 45.0, -110.0, -80.0)
REPLAY_KEYS = ("icao24", "last_contact", "lat", "lon", "altitude_m", "velocity_mps")


def _out(df: DataFrame) -> DataFrame:
    """Comparable output types."""
    zoneless = {
        f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)
    }
    averages = {
        f.name: F.round(f.name, 6) for f in df.schema
        if isinstance(f.dataType, T.DoubleType) and f.name.startswith("avg_")
    }
    return df.withColumns({**zoneless, **averages}) if zoneless or averages else df


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.events(configure(spark), sf_dir)


def _spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.spread(_events(spark, sf_dir))


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.telemetry(_events(spark, sf_dir))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_state(_telemetry(spark, sf_dir))


def _normalized(rows: DataFrame) -> DataFrame:
    typed = rows.withColumn("state", vector_from_text(F.col("state")))
    return normalize_vectors(typed, bbox_id(*BOX), F.col("ingestion_ts"))


def _run_stream(df: DataFrame, writer, checkpoint: str, mode: str) -> None:
    query = (
        df.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).outputMode(mode)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


# messages

def _damaged_messages(telemetry: DataFrame) -> DataFrame:
    """Event messages, of which one in fifty each is cut off, has a fractional time, or lacks its id."""
    kind = F.col("event_id") % 50
    rows = with_event_text(telemetry, "events", SCHEMA_VERSION).withColumns({
        "event_time_utc": F.when(kind == 2, F.replace("event_time_utc", F.lit("Z"), F.lit(".5Z")))
        .otherwise(F.col("event_time_utc")),
        "icao24": F.when(kind != 3, F.col("icao24")),
    })
    body = F.to_json(F.struct(*TELEMETRY.fieldNames()), {"ignoreNullFields": "false"})
    return rows.select(F.when(kind == 1, F.left(body, F.length(body) - 5)).otherwise(body).alias("value"))


def q_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_events(_damaged_messages(P.telemetry(_events(spark, sf_dir))))
    good = F.col("dead").isNull()
    names = ["icao24", "callsign", "source", "lat", "lon", "altitude_m", "velocity_mps", "heading_deg",
             "vertical_rate_mps", "on_ground", "event_ts", "ingestion_ts"]
    return _out(parsed.select(
        *[F.when(good, F.col(n)).alias(n) for n in names],
        F.col("dead.error_type").alias("error_type"), F.col("dead.message").alias("message"),
    ))


def q_parse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.readings(_events(spark, sf_dir))
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = rows.withColumn("timestamp", text).select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    return _out(parse_readings(raw))


def q_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_event_text(P.telemetry(_events(spark, sf_dir)), "events", SCHEMA_VERSION)
    body = F.col("value").cast("string")
    read = to_event_messages(rows).select(
        F.col("key").cast("string").alias("message_key"), F.size(F.json_object_keys(body)).alias("fields"),
        F.from_json(body, TELEMETRY).alias("d"),
    )
    names = ["schema_version", "source", "icao24", "callsign", "event_time_utc", "ingestion_time_utc", "lat",
             "altitude_m", "on_ground", "squawk"]
    return read.select("message_key", "fields", *[F.col(f"d.{n}") for n in names])


# ingest

def _polls(vectors: DataFrame) -> DataFrame:
    """Poll responses of at most fifty vectors, and between them as many seventh ones that have no vectors at all."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "state"))),
                                      lambda s: s["state"]), ",")
    full = vectors.groupBy("poll_id").agg(F.concat(F.lit('{"time":0,"states":['), listed, F.lit("]}")).alias("value"))
    empty = vectors.where(F.col("poll_id") % 7 == 3).select((-F.col("poll_id") - 1).alias("poll_id")).distinct()
    return full.unionByName(empty.withColumn("value", F.lit('{"time":0,"states":null}')))


def q_explode_state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_state_vectors(_polls(P.vectors(_events(spark, sf_dir))))
    field = vector_fields(F.col("state"))

    def read(name: str, type_name: str) -> Column:
        return F.try_variant_get(field[name], "$", type_name).alias(name)

    return rows.select(
        "poll_id", F.col("state_pos").cast("bigint").alias("state_pos"),
        read("icao24", "string"), read("lon", "double"), read("lat", "double"), read("on_ground", "boolean"),
        read("squawk", "string"),
        (F.schema_of_variant(field["lat"]) == "STRING").alias("lat_is_text"),
    )


def q_normalize_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = route_events(_normalized(P.vectors(_events(spark, sf_dir))))
    return valid.select("event_id", "altitude_suppressed", *TELEMETRY.fieldNames())


def _dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_events(_normalized(P.vectors(_events(spark, sf_dir))))[1]


def q_route_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_dead_letter_messages(_dead(spark, sf_dir))
    body = F.col("value").cast("string")

    def read(name: str, path: str, type_name: str = "string") -> Column:
        return F.get_json_object(body, path).cast(type_name).alias(name)

    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        read("error_time_utc", "$.error_time_utc"), read("error_type", "$.error_type"),
        read("raw_icao24", "$.raw_icao24"), read("state_len", "$.raw_payload.state_len", "int"),
        read("message", "$.message"),
    )


def q_dlq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq_counts(_dead(spark, sf_dir))


def q_ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised rows are written once: counting and de-duplication read them several times, a few columns each."""
    normalized = landed(_normalized(P.repolled(_events(spark, sf_dir))), "normalized")
    valid, _ = route_events(normalized)
    clocked = valid.select(*DEDUPE_KEYS, "event_id", "poll_id", clock_seconds(F.col("ingestion_ts")).alias("clock_s"))
    return ingest_counters(normalized, dedupe_ttl(clocked, tiebreak=["event_id"]))


def q_dedupe_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(dedupe_ttl(P.replays(_spread_events(spark, sf_dir)), REPLAY_KEYS))


def _in_turns(rows: DataFrame, order: Column, base: str, catch_up: Callable[[DataFrame], None], turns: int = 3) -> None:
    """Land rows in several turns, in their order, and let a stream of them catch up after each: several batches, and a
    restart from the checkpoint between them."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    step = (high - low) // turns + 1
    for turn in range(turns):
        rows.where((order >= low + turn * step) & (order < low + (turn + 1) * step)).write.mode("append").parquet(
            f"{base}/in")
        catch_up(rows.sparkSession.readStream.schema(rows.schema).parquet(f"{base}/in"))


def _passed_in_turns(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame, str, Callable], None]) -> DataFrame:
    """The replays, de-duplicated by a stream in three batches with restarts."""
    rows = P.replays(_spread_events(spark, sf_dir))
    base = work_dir(spark, "dedupe")

    def keep(passed: DataFrame, batch_id: int) -> None:
        passed.write.mode("overwrite").parquet(f"{base}/passed/batch={batch_id}")

    _in_turns(rows, F.col("clock_s"), base, lambda part: run(part, base, keep))
    return _out(spark.read.schema(rows.schema).parquet(f"{base}/passed").select(*rows.columns))


def q_dedupe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passed_in_turns(spark, sf_dir, lambda rows, base, keep: _run_stream(
        rows, dedupe_batches(FolderTarget(f"{base}/tables"), keep, REPLAY_KEYS), f"{base}/checkpoint", "append"))


def q_dedupe_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passed_in_turns(spark, sf_dir, lambda rows, base, keep: _run_stream(
        dedupe_keyed(rows, REPLAY_KEYS), keep, f"{base}/checkpoint", "append"))


class _FailsOnce:
    """A message sink that breaks down after a batch has been written for the first time, as a lost connection would."""

    def __init__(self, path: str, batch_id: int):
        self.path, self.batch_id, self.failed = path, batch_id, False

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if batch_id == self.batch_id and not self.failed:
            self.failed = True
            raise ConnectionError("the sink is gone")


def _run_ingest(spark: SparkSession, sf_dir: str) -> tuple[str, FolderTarget]:
    """Polls to messages in three batches, of which the second runs twice."""
    base = work_dir(spark, "ingest")
    target = FolderTarget(f"{base}/tables")
    rows = P.polled(_spread_events(spark, sf_dir))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "state"))),
                                      lambda s: s["state"]), ",")
    polls = rows.groupBy("poll_id", "ingestion_ts").agg(
        F.concat(F.lit('{"time":0,"states":['), listed, F.lit("]}")).alias("value"))
    events = _FailsOnce(f"{base}/events", 1)

    def dead(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{base}/dead/batch={batch_id}")

    def catch_up(part: DataFrame) -> None:
        for _ in range(2):
            query = start_ingest(part, events, dead, f"{base}/checkpoint", bbox_id(*BOX), dedupe_in=target,
                                 trigger={"availableNow": True}, count_in=target, now=F.col("ingestion_ts"))
            try:
                query.awaitTermination()
                return
            except StreamingQueryException as error:
                if "the sink is gone" not in str(error):
                    raise

    _in_turns(polls, F.col("poll_id"), base, catch_up)
    return base, target


def q_ingest_counters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = _run_ingest(configure(spark), sf_dir)
    return read_ingest_counts(spark, target)


def q_ingest_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the polls became: event messages without repeats, and dead letters."""
    base, _ = _run_ingest(configure(spark), sf_dir)
    body = F.col("value").cast("string")

    def read(kind: str, time: str, *paths: str) -> DataFrame:
        rows = spark.read.schema("key binary, value binary").parquet(f"{base}/{kind}")
        return rows.select(
            F.lit(kind).alias("topic"), F.col("key").cast("string").alias("message_key"),
            F.get_json_object(body, time).alias("at"),
            *[F.get_json_object(body, path).alias(f"field_{n}") for n, path in enumerate(paths)])

    events = read("events", "$.ingestion_time_utc", "$.icao24", "$.last_contact_utc", "$.bbox_id")
    dead = read("dead", "$.error_time_utc", "$.raw_icao24", "$.error_type", "$.message")
    return events.unionByName(dead).groupBy(*events.columns).agg(F.count("*").alias("messages"))


# aggregates

def q_within_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(within_bbox(_telemetry(spark, sf_dir), *BOX).select("event_id", "icao24", "event_ts", "lat", "lon"))


def q_within_bbox_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from positions stored along a space-filling curve."""
    path = work_dir(spark, "positions")
    write_positions(_telemetry(spark, sf_dir), path, files=8, also="event_ts")
    return _out(within_bbox_stored(spark, path, *BOX).select("event_id", "icao24", "event_ts", "lat", "lon"))


def q_airspace_grid_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(airspace_grid_5m(_telemetry(spark, sf_dir)))


def q_airspace_grid_5m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.telemetry(P.events_stream(configure(spark), sf_dir))
    base = work_dir(spark, "grid")
    target = FolderTarget(f"{base}/tables")
    _run_stream(airspace_grid_5m(rows), append_windows(target, GRID_5M), f"{base}/checkpoint", "append")
    return _out(target.windows(spark, GRID_5M).withColumn("aircraft_count", F.col("aircraft_count").cast("bigint")))


def q_telemetry_quality_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(telemetry_quality_5m(_telemetry(spark, sf_dir)))


def q_traffic_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.readings(_events(spark, sf_dir)).where(F.col("sensor_type") == "traffic")
    return _out(traffic_hourly(rows))


def q_traffic_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.readings(_events(spark, sf_dir)).where(F.col("sensor_type") == "traffic")
    return _out(traffic_5m(rows))


# keyed tables

def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_state(spark, sf_dir))


def q_upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in two batches, the second of which mixes newer and older ones."""
    rows = _telemetry(spark, sf_dir)
    target = FolderTarget(work_dir(spark, "state"))
    for batch_id in (0, 1):
        half = to_state_rows(rows.where(F.col("event_id") % 2 == batch_id))
        target.upsert(half, STATE, batch_id, updated_at="incoming")
    return _out(target.keyed(spark, STATE))


def q_upsert_state_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in four batches into buckets, each with newer and older rows, one of them twice and a new base between."""
    rows = _telemetry(spark, sf_dir)
    target = BucketedTarget(work_dir(spark, "buckets"), buckets=8)
    for batch_id in (0, 1, 2, 2, 3):
        part = to_state_rows(rows.where(F.col("event_id") % 4 == batch_id))
        target.upsert(part, STATE, batch_id, updated_at="incoming")
        target.compact(spark, STATE, least=2)
    return _out(target.read(spark, STATE))


def q_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of each day are stored, two thirds arrive; where they overlap the stored row stays."""
    grid = airspace_grid_5m(_telemetry(spark, sf_dir))
    hour = F.hour("window_start")
    arriving = grid.where(hour >= 8).withColumn("aircraft_count", F.col("aircraft_count") + 100)
    return _out(insert_if_absent(arriving, grid.where(hour < 16), ["window_start", "grid_cell"]))


# views

def q_live_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    return _out(live_positions(state, state.agg(F.max("updated_at_utc")).scalar(), "1 day"))


def q_live_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(live_kpis(live_positions(_state(spark, sf_dir))))


def q_top_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_state(spark, sf_dir), "velocity_mps")


def q_top_altitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_state(spark, sf_dir), "altitude_m")


def q_top_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_state(spark, sf_dir), "vertical_rate_mps")


def q_to_imperial(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["velocity_mps", "altitude_m", "vertical_rate_mps"]
    converted = to_imperial(_state(spark, sf_dir).select("icao24", *names), rounded=False)
    return converted.select("icao24", *[F.round(n, 6).alias(n) for n in names])


def q_to_imperial_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As shown: rounded half to even, to one digit, none and one."""
    names = ["velocity_mps", "altitude_m", "vertical_rate_mps"]
    return to_imperial(_state(spark, sf_dir).select("icao24", *names))


def _busy_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_state(P.busy(_events(spark, sf_dir)))


def q_live_positions_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of an hour of telemetry, of which the last five minutes are live."""
    state = _busy_state(spark, sf_dir)
    return _out(live_positions(state, state.agg(F.max("updated_at_utc")).scalar()))


def q_airspace_density_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of a few windows with many cells, each of many messages."""
    return _out(airspace_density(airspace_grid_5m(P.busy(_events(spark, sf_dir)))))


def q_airspace_density_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stored table of many dates, of which the last one is read."""
    target = FolderTarget(work_dir(spark, "stored"))
    rows = _events(spark, sf_dir)
    later = P.busy(rows).withColumn("event_ts", F.col("event_ts") + F.expr("interval 60 days"))
    for batch_id, part in enumerate((_telemetry(spark, sf_dir), later)):
        append_windows(target, GRID_5M)(airspace_grid_5m(part), batch_id)
    found = airspace_density(target.newest_window(spark, GRID_5M))
    return _out(found.withColumn("aircraft_count", F.col("aircraft_count").cast("bigint")))


def q_airspace_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest window is found from the times alone, and only its rows are aggregated."""
    rows = with_position(_telemetry(spark, sf_dir))
    newest = F.unix_timestamp(rows.agg(F.max("event_ts")).scalar())
    recent = rows.where(F.col("event_ts") >= F.timestamp_seconds(newest - F.pmod(newest, F.lit(300))))
    return _out(airspace_density(airspace_grid_5m(recent)))


def q_quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(quality_history(telemetry_quality_5m(_telemetry(spark, sf_dir))))


def q_quality_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(quality_headline(telemetry_quality_5m(_telemetry(spark, sf_dir))))


def q_export_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _telemetry(spark, sf_dir)
    base = work_dir(spark, "snapshots")
    write_snapshots({
        "realtime_flight_state": latest_state(rows),
        "realtime_airspace_grid_5m": airspace_grid_5m(rows),
        "telemetry_quality_5m": telemetry_quality_5m(rows),
    }, base)

    def read(name: str, window: str, key: str, amount: str) -> DataFrame:
        return load_table(spark, name, "snapshot", base).select(
            F.lit(name).alias("table_name"), F.col(window).alias("at"), F.expr(key).alias("row_key"),
            F.col(amount).cast("double").alias("amount"),
        )

    return _out(
        read("realtime_flight_state", "last_event_time_utc", "icao24", "altitude_m")
        .unionByName(read("realtime_airspace_grid_5m", "window_start", "grid_cell", "aircraft_count"))
        .unionByName(read("telemetry_quality_5m", "window_start", "''", "total_messages"))
    )


# running pipelines

def _fed(rows: DataFrame, time: str, to_messages: Callable[[DataFrame], DataFrame],
         start: Callable[[DataFrame, str], dict], base: str, turns: int = 3, turn_of: Callable | None = None) -> None:
    """Land rows as messages in several turns, in time order, and let the queries catch up after each: several
    batches, and a restart from the checkpoint between them. ``turn_of`` may move rows to a later turn than their own.
    """
    spark = rows.sparkSession
    seconds = F.unix_timestamp(time)
    low, high = rows.agg(F.min(seconds), F.max(seconds)).first()
    own = F.floor((seconds - low) / ((high - low) // turns + 1))
    placed = turn_of(own) if turn_of else own
    for turn in range(turns):
        to_messages(rows.where(placed == turn)).select("key", "value").write.mode("append").parquet(f"{base}/in")
        raw = read_event_stream(spark, "parquet", f"{base}/in")
        await_queries(start(raw, f"{base}/checkpoint"))


def _messages(part: DataFrame) -> DataFrame:
    return to_event_messages(with_event_text(part, "events", SCHEMA_VERSION))


def _run_pipeline(spark: SparkSession, sf_dir: str, mode: str, starter: Callable = start_pipeline) -> FolderTarget:
    base = work_dir(spark, "pipeline")
    target = FolderTarget(f"{base}/tables")
    _fed(_telemetry(spark, sf_dir), "event_ts", _messages,
         lambda raw, checkpoint: starter(raw, target, checkpoint, mode, trigger={"availableNow": True}), base)
    return target


def _tables(read: Callable[[Table], DataFrame]) -> DataFrame:
    """The three tables in one shape."""
    def rows(table: Table, at: str, key: str, amount: str) -> DataFrame:
        return read(table).select(
            F.lit(table.name).alias("table_name"), F.col(at).alias("at"), F.expr(key).alias("row_key"),
            F.expr(amount).cast("double").alias("amount"))

    return _out(rows(STATE, "last_event_time_utc", "icao24", "1")
                .unionByName(rows(GRID_5M, "window_start", "grid_cell", "aircraft_count"))
                .unionByName(rows(QUALITY_5M, "window_start", "''", "total_messages")))


def q_pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _run_pipeline(spark, sf_dir, "append")
    return _tables(lambda table: target.read(spark, table.name))


def q_pipeline_tables_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables, from messages that are parsed once."""
    target = _run_pipeline(spark, sf_dir, "append", start_shared_pipeline)
    return _tables(lambda table: target.read(spark, table.name))


def q_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables, read by their names in the catalog."""
    target = _run_pipeline(spark, sf_dir, "append", start_shared_pipeline)
    database = f"telemetry_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for table in (STATE, GRID_5M, QUALITY_5M):
        target.publish(spark, table, database)
    return _tables(lambda table: spark.table(f"{database}.{table.name}"))


HELD_BACK = 40


def _late(turn: Column) -> Column:
    """One message in forty comes in the last turn, whatever its time."""
    return F.when(F.col("event_id") % HELD_BACK == 7, 2).otherwise(turn)


def q_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come when the watermark has closed their window, with what they carry."""
    base = work_dir(spark, "late")
    target = FolderTarget(f"{base}/tables")
    rows = _telemetry(spark, sf_dir)

    def keep(late: DataFrame, batch_id: int) -> None:
        late.write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")

    _fed(rows, "event_ts", _messages, lambda raw, checkpoint: start_shared_pipeline(
        raw, target, checkpoint, late=keep, trigger={"availableNow": True}), base, turn_of=_late)
    found = spark.read.parquet(f"{base}/late")
    return _out(found.select("batch", "icao24", "callsign", "event_ts", "lat", "lon", "altitude_m"))


def q_stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queries of a pipeline report, and a query that fails beside another."""
    base = work_dir(spark, "progress")
    target = FolderTarget(f"{base}/tables")
    rows = P.telemetry(_spread_events(spark, sf_dir))

    def broken(batch: DataFrame, batch_id: int) -> None:
        raise ConnectionError("the sink is gone")

    with ProgressLog(spark, f"{base}/log") as log:
        _fed(rows, "event_ts", _messages, lambda raw, checkpoint: start_shared_pipeline(
            raw, target, checkpoint, trigger={"availableNow": True}), base, turn_of=_late)
        raw = read_event_stream(spark, "parquet", f"{base}/in")
        both = {
            name: raw.writeStream.queryName(name).foreachBatch(sink).option("checkpointLocation", f"{base}/{name}").start()
            for name, sink in (("waiting_query", lambda batch, batch_id: None), ("broken_query", broken))}
        try:
            await_queries(both)
            reported = None
        except QueryFailed as failure:
            reported = str(failure).split(":")[0]
    batches = log.batches().where(F.col("name") == "parsed_layer")
    read = batches.agg(F.count_if(F.col("rows") > 0).alias("batches"), F.sum("rows").alias("rows"))
    dropped = log.batches().where(F.col("late_rows") > 0).select("name").distinct()
    ended = log.ended().groupBy("name").agg(F.count("*").alias("runs"), F.count("error").alias("failed_runs"))
    return ended.join(dropped.withColumn("dropped_rows", F.lit(True)), "name", "left").join(
        read.withColumn("name", F.lit("parsed_layer")), "name", "left").select(
        "name", "runs", "failed_runs", F.coalesce("dropped_rows", F.lit(False)).alias("dropped_rows"), "batches", "rows",
        (F.col("name").eqNullSafe(F.lit(reported))).alias("reported"))


def q_live_positions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every appearance and removal of a vehicle, and the positions that are live in the end."""
    base = work_dir(spark, "live")
    target = FolderTarget(f"{base}/tables")
    apply = keep_live(target)

    def write(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{base}/changes/batch={batch_id}")
        apply(spark.read.parquet(f"{base}/changes/batch={batch_id}"), batch_id)

    def catch_up(rows: DataFrame) -> None:
        changes = live_changes(rows, max_age=300, tiebreak=["event_ts", "event_id"])
        _run_stream(changes, write, f"{base}/checkpoint", "append")

    _in_turns(_telemetry(spark, sf_dir), F.unix_timestamp("ingestion_ts"), base, catch_up)
    changes = spark.read.parquet(f"{base}/changes").where(F.col("change") != "moved")
    live = read_live(spark, target).withColumn("change", F.lit("live")).withColumnRenamed("updated_at_utc", "at")
    names = ["icao24", "change", "at", "lat", "lon", "altitude_m"]
    return _out(changes.select(*names).unionByName(live.select(*names)))


def q_grid_live_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open windows too, each as it was last emitted."""
    grid = _run_pipeline(spark, sf_dir, "update").read(spark, GRID_5M.name)
    return _out(grid.withColumn("aircraft_count", F.col("aircraft_count").cast("bigint")))


def q_insert_absent_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is written twice, as after a failure."""
    base = work_dir(spark, "absent")
    target = FolderTarget(f"{base}/tables")
    write = insert_absent_windows(target, GRID_5M)

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    rows = P.telemetry(P.events_stream(configure(spark), sf_dir))
    _run_stream(airspace_grid_5m(rows), twice, f"{base}/checkpoint", "append")
    return _out(target.windows(spark, GRID_5M).withColumn("aircraft_count", F.col("aircraft_count").cast("bigint")))


def _run_traffic(spark: SparkSession, sf_dir: str) -> FolderTarget:
    base = work_dir(spark, "traffic")
    target = FolderTarget(f"{base}/tables")

    def messages(part: DataFrame) -> DataFrame:
        text = part.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        return text.select(F.lit(None).cast("binary").alias("key"), F.to_json(F.struct("*")).cast("binary").alias("value"))

    # Both queries read the whole stream, so it is fed in one order for both.
    _fed(P.readings(_events(spark, sf_dir)), "timestamp", messages,
         lambda raw, checkpoint: start_traffic(raw, target, checkpoint, trigger={"availableNow": True}), base)
    return target


def q_traffic_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(_run_traffic(spark, sf_dir).windows(spark, TRAFFIC_1H))


def q_traffic_5m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _run_traffic(spark, sf_dir).windows(spark, TRAFFIC_5M)
    return _out(rows.withColumn("data_points", F.col("data_points").cast("bigint")))


def registry() -> dict:
    return {name[2:]: function for name, function in globals().items() if name.startswith("q_")}
