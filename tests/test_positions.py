"""Space-filling codes, the ranges of a box, and what a stored box and a newest window read."""

import datetime as dt
import random

from pyspark.sql import functions as F

from contrail.functions.grid import morton_code, morton_ranges
from contrail.operators import airspace_density
from contrail.schemas import GRID_5M
from contrail.sources import FolderTarget, within_bbox_stored, write_positions
from contrail.streaming import append_windows


def plain_code(lat, lon):
    y, x = (min(max(int((v - low) / span * 65536 // 1), 0), 65535) for v, low, span in ((lat, -90, 180), (lon, -180, 360)))
    return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(16))


def test_codes(spark):
    rng = random.Random(1)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)] + [(90.0, 180.0), (-90.0, -180.0)]
    df = spark.createDataFrame([*places, (None, 1.0)], "lat double, lon double")
    found = df.select("lat", "lon", morton_code(F.col("lat"), F.col("lon")).alias("c")).collect()
    assert all(r.c == (None if r.lat is None else plain_code(r.lat, r.lon)) for r in found)


def test_ranges_hold_every_place_of_the_box_and_few_others():
    rng = random.Random(2)
    for _ in range(30):
        (a, b), (c, d) = (sorted(rng.uniform(-limit, limit) for _ in range(2)) for limit in (90, 180))
        ranges = morton_ranges(a, b, c, d)
        assert len(ranges) <= 80 and ranges == sorted(ranges)
        for _ in range(50):
            code = plain_code(rng.uniform(a, b), rng.uniform(c, d))
            assert any(low <= code <= high for low, high in ranges)
        assert all(any(low <= plain_code(y, x) <= high for low, high in ranges) for y in (a, b) for x in (c, d))
    share = sum(high - low + 1 for low, high in morton_ranges(10, 20, 30, 50)) / 2 ** 32
    assert share < 1.6 * (10 / 180) * (20 / 360)
    assert morton_ranges(2, 1, 0, 1) == [] and morton_ranges(-90, 90, -180, 180) == [(0, 2 ** 32 - 1)]


def rows_read(df):
    """Rows that the scan gave out, which leaves out those of row groups it has passed over."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_a_box_reads_few_row_groups(spark, tmp_path):
    rows = spark.range(20_000).select("id", ((F.col("id") * 7919 % 18_000) / 100 - 90).alias("lat"),
                                      ((F.col("id") * 104_729 % 36_000) / 100 - 180).alias("lon"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, 2.0)], "id long, lat double, lon double"))
    write_positions(rows, str(tmp_path / "p"), files=16, also="id")
    box = (10.0, 20.0, 30.0, 50.0)
    found = within_bbox_stored(spark, str(tmp_path / "p"), *box)
    expected = {r.id for r in rows.where(F.col("lat").between(10, 20) & F.col("lon").between(30, 50)).collect()}
    assert {r.id for r in found.collect()} == expected and found.columns == ["id", "lat", "lon"] and expected
    assert rows_read(found) <= 4 * 20_001 / 16
    assert spark.read.parquet(str(tmp_path / "p")).count() == 20_001


def test_the_newest_window_reads_one_date(spark, tmp_path):
    target = FolderTarget(str(tmp_path))
    assert target.newest_date(spark, GRID_5M) is None and target.newest_window(spark, GRID_5M).count() == 0
    start = dt.datetime(2024, 1, 1)
    for day in range(5):
        rows = [(start + dt.timedelta(days=day, minutes=m), start + dt.timedelta(days=day, minutes=m + 5), f"{c}.0_1.0", 1,
                 1.0, 1.0) for m in (0, 5) for c in range(20)]
        append_windows(target, GRID_5M)(spark.createDataFrame(rows, GRID_5M.schema), day)
    newest = target.newest_window(spark, GRID_5M)
    assert newest.count() == 20 and airspace_density(newest).count() == 20
    read = {f.split("window_date=")[1][:10] for f in target.windows(spark, GRID_5M, since=dt.date(2024, 1, 5)).select(
        F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert read == {"2024-01-05"} and target.newest_date(spark, GRID_5M) == dt.date(2024, 1, 5)
    assert "PartitionFilters: [isnotnull(window_date" in newest._jdf.queryExecution().executedPlan().toString()
