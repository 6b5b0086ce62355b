import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import accepted_last, dedupe_ttl, dedupe_within_watermark
from contrail.sources import FolderTarget
from contrail.streaming import dedupe_stream


def brute_force(rows, ttl, last=None):
    """(key, clock, n) rows in clock order -> those that pass."""
    last, passed = dict(last or {}), []
    for key, clock, n in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or clock >= last[key] + ttl:
            last[key] = clock
            passed.append((key, clock, n))
    return sorted(passed, key=str)


def run(spark, rows, ttl, span, seen=None):
    df = spark.createDataFrame(rows, "k string, t long, n int")
    if seen is not None:
        seen = spark.createDataFrame(list(seen.items()), "k string, t long")
    return sorted((tuple(r) for r in dedupe_ttl(df, ["k"], ttl, "t", ["n"], seen, span).collect()), key=str)


def test_golden(spark):
    rows = [("a", t, 0) for t in (0, 60, 119, 120, 200, 241)]
    assert [r[1] for r in run(spark, rows, 120, 86_400)] == [0, 120, 241]
    assert [r[1] for r in run(spark, [("a", 5, 2), ("a", 5, 1), ("a", 5, 3)], 120, 86_400)] == [5]
    assert run(spark, [("a", 5, 2), ("a", 5, 1)], 120, 86_400) == [("a", 5, 1)]
    assert [r[1] for r in run(spark, [("a", 0, 0), ("a", 120, 0)], 120, 86_400)] == [0, 120]
    assert len(run(spark, [(None, 0, 0), (None, 1, 0), ("", 1, 0)], 120, 86_400)) == 2


@pytest.mark.parametrize("ttl,span", [(1, 1), (5, 5), (5, 7), (10, 10), (10, 64), (7, 1000)])
def test_against_brute_force(spark, ttl, span):
    """Sparse, dense and bursty time lines, before and after zero, cut into slots of any length."""
    rng = random.Random(ttl * 1000 + span)
    rows = []
    for case in range(60):
        width = rng.choice([10, 50, 300])
        for n in range(rng.choice([1, 5, 40, 200])):
            rows.append((rng.choice(["x", "y", None]) and f"{case}", rng.randint(-width, width), n))
    assert run(spark, rows, ttl, span) == brute_force(rows, ttl)


def test_one_hot_key_over_many_slots(spark):
    """A row every unit: the chain runs through every slot border."""
    rows = [("hot", t, 0) for t in range(3000)] + [("cold", t, 0) for t in range(0, 3000, 700)]
    assert run(spark, rows, 120, 125) == brute_force(rows, 120)


def test_order_of_rows_does_not_matter(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randint(0, 100), n) for n in range(80)]
    expected = run(spark, rows, 9, 20)
    rng.shuffle(rows)
    assert run(spark, rows, 9, 20) == expected


def test_seen(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.randint(100, 160), n) for n in range(60)]
    last = {"a": 98, "b": 40, "z": 99}
    assert run(spark, rows, 10, 16, last) == brute_force(rows, 10, last)


def test_ttl_zero_switches_it_off(spark):
    assert len(run(spark, [("a", 0, 0), ("a", 0, 1)], 0, 10)) == 2


def test_all_key_parts_and_null_parts_count(spark):
    ddl = "icao24 string, last_contact_utc string, lat double, lon double, altitude_m double, velocity_mps double, clock_s long"
    base = ("a", "2023-11-14T22:13:25Z", 41.8, -87.6, 100.0, 5.0)
    variants = [base, base, ("b", *base[1:]), (*base[:2], None, *base[3:]), (*base[:2], None, *base[3:]),
                ("a", "2023-11-14T22:13:35Z", *base[2:]), (*base[:5], 6.0), (*base[:2], -0.0, *base[3:]),
                (*base[:2], 0.0, *base[3:])]
    df = spark.createDataFrame([(*v, i) for i, v in enumerate(variants)], ddl)
    assert dedupe_ttl(df).count() == 6


def test_hot_key_is_spread_by_its_clock(spark):
    """The first shuffle is by key and clock, the one that gathers rows by key and slot: none is by key alone."""
    df = spark.createDataFrame([("k", 1, "x"), ("l", 2, "y")], "k string, t long, n string")
    plan = dedupe_ttl(df, ["k"], 5, "t")._jdf.queryExecution().executedPlan().toString()
    gathers = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("_slot" in line and "_t#" in line for line in gathers)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_stream_equals_batch_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.choice("abcd"), t // 2, t) for t in range(400)]
    parts = [rows[:150], rows[150:220], rows[220:]]
    target, got = FolderTarget(str(tmp_path / "tables")), []

    def sink(passed, batch_id):
        got[batch_id:] = [[tuple(r) for r in passed.collect()]]

    for batch_id, part in enumerate(parts):
        writer = dedupe_stream(target, sink, ["k"], 15, "t")
        df = spark.createDataFrame(part, "k string, t long, n int")
        for _ in range(2 if batch_id == 1 else 1):  # a replayed batch gives the same result
            writer(df, batch_id)
    assert sorted((r for part in got for r in part), key=str) == brute_force(rows, 15)
    state = target.keyed(spark, "dedupe_seen")
    assert state.count() <= 4 and state.agg(F.min("t")).first()[0] > rows[-1][1] - 15


def test_expired_keys_leave_the_state(spark):
    passed = spark.createDataFrame([("a", 0), ("b", 90), ("b", 30)], "k string, t long")
    got = accepted_last(passed, None, ["k"], 50, "t", now=100)
    assert [tuple(r) for r in got.collect()] == [("b", 90)]


def test_within_watermark(spark, tmp_path):
    """One copy per key while the key is held; a new one once the watermark has passed it."""
    schema, got = "k string, ingestion_ts timestamp", []
    for n, seconds in enumerate([(0, 60), (500,), (510,), (520,)]):
        rows = spark.createDataFrame([("a", s) for s in seconds], "k string, s long")
        rows.select("k", F.timestamp_seconds("s").alias("ingestion_ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        query = (
            dedupe_within_watermark(source, ["k"], 120).writeStream
            .foreachBatch(lambda batch, _: got.extend(r.ingestion_ts.timestamp() for r in batch.collect()))
            .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert len(got) == 2 and got[0] in (0, 60) and got[1] in (500, 510)
