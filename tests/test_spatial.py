"""Geometry, containment and the streaming landing."""

import numpy as np
from pyspark.sql import functions as F

from parcelflow.functions.geometry import (contains_point, interior_point, multipolygon_wkb, polygon_wkb,
                                           squares_wkb, wkb_polygons, wkb_rings)
from parcelflow.operators import spatial
from parcelflow.plans import adapters as A
from parcelflow.plans import catalog, fixtures
from parcelflow.streaming.incremental import land_layers
from conftest import rows

SQUARE = [np.array([[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], float)]
HOLE = SQUARE + [np.array([[3, 3], [3, 7], [7, 7], [7, 3], [3, 3]], float)]
U = [np.array([[0, 0], [9, 0], [9, 9], [6, 9], [6, 3], [3, 3], [3, 9], [0, 9], [0, 0]], float)]


def _inside(rings, x, y):
    c = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                c = not c
    return c


def test_wkb_round_trip_and_interior_points():
    assert [r.tolist() for r in wkb_rings(polygon_wkb(HOLE))] == [r.tolist() for r in HOLE]
    mp = multipolygon_wkb([SQUARE, [SQUARE[0] + 20]])
    assert len(wkb_rings(mp)) == 2
    assert wkb_rings(squares_wkb([1.0], [2.0], [3.0], [4.0])[0])[0].tolist() == \
        [[1, 2], [3, 2], [3, 4], [1, 4], [1, 2]]
    for rings in (SQUARE, HOLE, U):
        x, y = interior_point(rings)
        assert _inside(rings, x, y), (rings, x, y)
    x, y = interior_point(wkb_polygons(mp))
    assert _inside(wkb_rings(mp), x, y)


def test_contains_point_in_spark(spark):
    pts = [(5.0, 5.0), (1.0, 1.0), (11.0, 5.0), (5.0, 1.5)]
    flat = [[float(v) for v in r.ravel()] for r in HOLE]
    df = spark.createDataFrame([(x, y) for x, y in pts], "x double, y double")
    got = [r.c for r in df.select(contains_point(F.array(*[F.array(*[F.lit(v) for v in r]) for r in flat]),
                                                 F.col("x"), F.col("y")).alias("c")).collect()]
    assert got == [_inside(HOLE, x, y) for x, y in pts] == [False, True, False, True]


def test_locate_matches_brute_force_and_keeps_located_rows(spark, sf):
    subdivisions, communes = catalog._locate_inputs(spark, sf)
    got = spatial.locate_by_containment(subdivisions, communes, match_srid=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    u = subdivisions.select("id", "lettre", "parcelle", "commune", "geometry_bbox.*").toPandas()
    c = [(r.commune, [ring for ring in wkb_rings(bytes(r.geometry))]) for r in communes.select("commune", "geometry").collect()]
    expect = []
    for r in u.itertuples():
        if r.commune == "00000":
            hit = [k for k, rings in c if abs(rings[0][0][0] - r.xmin) < 101 and abs(rings[0][0][1] - r.ymin) < 101
                   and _inside(rings, r.xmin + 0.5, r.ymin + 0.5)]
            expect.append((r.id, r.lettre, r.parcelle, min(hit) if hit else "00000"))
        else:
            expect.append((r.id, r.lettre, r.parcelle, r.commune))
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(rows(got, "id", "lettre", "parcelle", "commune"), key=key) == sorted(expect, key=key)
    found = got.where("parcelle IS NULL")
    assert 0 < found.where("commune <> '00000'").count() < found.count()  # holes and notches stay unlocated


def _commune(spark, code, wkb, box):
    c = spark.createDataFrame([(code, code[:2], wkb)], "commune string, departement string, geometry binary")
    return c.withColumn("geometry_bbox", F.struct(*[F.lit(float(v)).cast("float").alias(n) for n, v in zip(("xmin", "ymin", "xmax", "ymax"), box)])).withColumn("geom_srid", F.lit(2154))


def test_commune_with_a_hundred_thousand_vertices(spark):
    """A ragged coast with a hole and an island: each point meets a few sides only."""
    rng = np.random.default_rng(8)
    turn = np.linspace(0, 2 * np.pi, 100_000, endpoint=False)
    radius = 5000 + 900 * np.sin(9 * turn) + rng.uniform(-60, 60, len(turn))
    ring = np.stack([6000 + radius * np.cos(turn), 6000 + radius * np.sin(turn)], 1)
    ring = np.concatenate([ring, ring[:1]])
    hole = np.array([[5000, 5000], [5000, 7000], [7000, 7000], [7000, 5000], [5000, 5000]], float)
    island = hole * 0.2 + 4800
    wkb = multipolygon_wkb([[ring, hole], [island]])
    box = (0, 0, 12000, 12000)
    communes = _commune(spark, "59350", wkb, box).unionByName(_commune(spark, "11111", squares_wkb([0.0], [0.0], [900.0], [900.0])[0], (0, 0, 900, 900)))
    shapes = spatial.prepared(communes)
    n = shapes.select(F.size("_sides").alias("n"), F.aggregate("_sides", F.lit(0).cast("bigint"), lambda acc, s: acc + spatial._band(F.greatest(s["ay"], s["by"])) - spatial._band(F.least(s["ay"], s["by"])) + 1).alias("cut")).collect()
    assert sorted(r["n"] for r in n)[-1] > 99_000 and all(r["cut"] <= 4 * r["n"] for r in n)
    xy = np.concatenate([rng.uniform(0, 12000, (3000, 2)), ring[rng.integers(0, len(ring), 500)] + rng.uniform(-30, 30, (500, 2)), rng.uniform(4700, 7100, (500, 2))])
    pts = spark.createDataFrame([(str(k), float(x), float(y), 2154) for k, (x, y) in enumerate(xy)], "_g string, _px double, _py double, _srid int")
    got = {int(r["_g"]): r["_commune"] for r in spatial.locate_points(pts, communes).collect()}

    def crossings(rings):
        odd = np.zeros(len(xy), bool)
        for r in rings:
            for k, (x, y) in enumerate(xy):
                a, b = r[:-1], r[1:]
                cut = (a[:, 1] > y) != (b[:, 1] > y)
                odd[k] ^= (x < (b[cut, 0] - a[cut, 0]) * (y - a[cut, 1]) / (b[cut, 1] - a[cut, 1]) + a[cut, 0]).sum() % 2 == 1
        return odd

    big, small = crossings([ring, hole, island]), (xy < 900).all(1)
    assert {k for k, v in got.items() if v == "59350"} == set(np.flatnonzero(big & ~small).tolist())
    assert {k for k, v in got.items() if v == "11111"} == set(np.flatnonzero(small).tolist())


def test_rings_are_not_shuffled(spark, sf):
    subdivisions, communes = catalog._locate_inputs(spark, sf)
    plan = spatial.locate_by_containment(subdivisions, communes, match_srid=False)._jdf.queryExecution().executedPlan().toString()
    assert "rings_of" not in plan and not [x for x in plan.splitlines() if "Exchange" in x and "_sides" in x]


def test_degenerate_communes_hold_nothing(spark):
    line = polygon_wkb([np.array([[0, 0], [9, 0], [0, 0], [0, 0]], float)])
    two = polygon_wkb([np.array([[0, 0], [9, 9]], float)])
    c = _commune(spark, "59350", line, (0, 0, 9, 9)).unionByName(_commune(spark, "59351", two, (0, 0, 9, 9))).unionByName(_commune(spark, "59352", None, (0, 0, 9, 9)))
    pts = spark.createDataFrame([("a", 3.0, 0.0, 2154), ("b", 3.0, 3.0, 2154), ("c", None, 3.0, 2154)], "_g string, _px double, _py double, _srid int")
    assert spatial.locate_points(pts, c).count() == 0 and spatial.locate_points(pts, c.limit(0)).count() == 0


def test_located_row_in_another_polygon_keeps_its_commune(spark):
    poly = squares_wkb([0.0], [0.0], [10.0], [10.0])[0]
    communes = spark.createDataFrame([("11111", "11", poly)], "commune string, departement string, geometry binary")
    communes = communes.withColumn("geometry_bbox", F.struct(*[F.lit(float(v)).cast("float").alias(n) for n, v in zip(("xmin", "ymin", "xmax", "ymax"), (0, 0, 10, 10))]))
    small = squares_wkb([2.0], [2.0], [3.0], [3.0])[0]
    feats = spark.createDataFrame([("a", "59001", "59", small), ("b", "00000", "000", small), ("c", "00000", "000", None)], "id string, commune string, departement string, geometry binary")
    got = rows(spatial.locate_by_containment(feats, communes, match_srid=False), "id", "commune", "departement")
    assert got == [("a", "59001", "59"), ("b", "11111", "11"), ("c", "00000", "000")]


def test_streaming_landing_is_incremental(spark, sf, tmp_path):
    landing, out, ck = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ck")
    fixtures.land_layer_files(spark, sf, landing, ("communes", "sections"))
    land_layers(spark, landing, out, ck)
    n1 = spark.read.parquet(out).count()
    land_layers(spark, landing, out, ck)  # nothing new
    assert spark.read.parquet(out).count() == n1
    fixtures.land_layer_files(spark, sf, landing, ("subdivisions_fiscales",))
    land_layers(spark, landing, out, ck)
    df = spark.read.parquet(out)
    assert df.count() == n1 + A.layer(spark, sf, "subdivisions_fiscales").count()
    assert df.where("type_objet = 'subdivisions_fiscales' AND commune = '00000'").count() > 0
