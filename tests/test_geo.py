"""The bounding box in front of the distance never loses a point."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_scanned
from docspark import Doc
from docspark.functions.geo import EARTH_RADIUS_M, bounding_box, covering_cells, geo_distance_m, geohash, within_distance


def distance(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat1 - lat2) / 2) ** 2
    b = math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon1 - lon2) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1, a + b)))


def in_box(box, lon, lat):
    low, high, ranges = box
    return low <= lat <= high and (ranges is None or any(w <= lon <= e for w, e in ranges))


def test_box_holds_every_point_of_the_circle():
    rng = random.Random(7)
    for _ in range(3000):
        centre = (rng.choice([rng.uniform(-180, 180), 179.9, -179.9, 180, -180]),
                  rng.choice([rng.uniform(-90, 90), 89.9, -89.9, 90, -90, 0]))
        reach = 10 ** rng.uniform(0, 7.31)
        box = bounding_box(*centre, reach)
        for _ in range(20):
            # a point at a bearing and a distance of at most `reach`
            bearing, arc = rng.uniform(0, 2 * math.pi), rng.choice([1, rng.random()]) * reach / EARTH_RADIUS_M
            lat0, lon0 = math.radians(centre[1]), math.radians(centre[0])
            lat = math.asin(max(-1, min(1, math.sin(lat0) * math.cos(arc)
                                        + math.cos(lat0) * math.sin(arc) * math.cos(bearing))))
            lon = lon0 + math.atan2(math.sin(bearing) * math.sin(arc) * math.cos(lat0),
                                    math.cos(arc) - math.sin(lat0) * math.sin(lat))
            lon = (math.degrees(lon) + 180) % 360 - 180
            assert in_box(box, lon, math.degrees(lat)), (centre, reach, lon, math.degrees(lat))


@pytest.mark.parametrize("centre", [(179.5, 10.0), (-179.5, -60.0), (0.0, 89.0), (12.0, -88.5), (84.0, 39.0)])
def test_filter_equals_plain_distance(spark, centre):
    rng = random.Random(3)
    points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(3000)]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    for reach in (50_000, 2_000_000, 12_000_000, 30_000_000):
        got = {r.id for r in df.where(within_distance(lon, lat, *centre, reach)).collect()}
        assert got == {i for i, x, y in points if distance(x, y, *centre) <= reach}
    far = df.select(F.max(geo_distance_m(lon, lat, *centre))).first()[0]
    assert math.isclose(far, max(distance(x, y, *centre) for _, x, y in points), rel_tol=1e-9)


def test_bad_points(spark):
    with pytest.raises(ValueError, match="longitude"):
        within_distance(F.col("a"), F.col("b"), 200, 0, 5)


def test_cells_cover_random_circles(spark):
    rnd = random.Random(17)
    points = [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(1500)]
    points += [(180.0, 0.0), (-180.0, 0.0), (179.9999, 89.9), (0.0, 90.0), (13.0, -90.0), (0.0, 0.0)]
    df = spark.createDataFrame(points, "lon double, lat double").select(
        F.struct("lon", "lat").alias("at"), geohash(F.col("lon"), F.col("lat")).alias("cell")).cache()
    circles = [(180, 0, 900_000), (-179.9, 60, 2_000_000), (0, 90, 1_500_000), (10, -89, 400_000), (0, 0, 20_100_000), (0, 0, 10)]
    circles += [(rnd.uniform(-180, 180), rnd.uniform(-90, 90), 10 ** rnd.uniform(3, 7)) for _ in range(25)]
    doc = Doc(df)
    tests = [F.count_if(test) for c in circles for test in (
        doc["at"].near(*c, cells="cell"), within_distance(F.col("at.lon"), F.col("at.lat"), *c))]
    counts = df.agg(*[t.alias(f"c{i}") for i, t in enumerate(tests)]).first()
    assert list(counts[::2]) == list(counts[1::2]) and sum(counts) > 500
    for c in circles:
        cells = covering_cells(*c)
        assert len(cells) <= 64 and all(b is None or a < b for a, b in cells)
        assert all(x[1] is not None and x[1] < y[0] for x, y in zip(cells, cells[1:]))


def test_cells_pass_over_row_groups(spark, tmp_path):
    spread = spark.range(0, 60000, numPartitions=1).select((F.rand(1) * 360 - 180).alias("lon"), (F.rand(2) * 180 - 90).alias("lat"))
    stored = spread.select(F.struct("lon", "lat").alias("at"), geohash(F.col("lon"), F.col("lat")).alias("cell"))
    stored.orderBy("cell").coalesce(1).write.option("parquet.block.size", 64 * 1024).option("parquet.page.size", 8192).parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    doc = Doc(points)
    box, cells = points.where(doc["at"].near(20, 10, 1_000_000)), points.where(doc["at"].near(20, 10, 1_000_000, cells="cell"))
    assert "GreaterThanOrEqual(cell" in plan_of(cells)
    assert rows_scanned(cells) < 0.7 * rows_scanned(box) and cells.count() == box.count() > 0
