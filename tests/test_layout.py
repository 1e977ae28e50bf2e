"""Order of the fused export, the zone table and what extents read."""

import os
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelflow.functions.grid import curve_key, with_curve_key
from parcelflow.operators import export, extract, unify
from parcelflow import schema
from parcelflow.plans import catalog, fixtures
from parcelflow.session import shared_dir
from parcelflow.sources.layers import read_published
from conftest import rows

KEYS = ["lot", "departement", "commune", "type_objet", "section"]


def _key(r):
    return tuple((r[k] is None, (r[k] or "")[:8] if k == "type_objet" else r[k] or "") for k in KEYS)


@pytest.fixture(scope="module")
def small_files(spark, tmp_path_factory):
    """The export of sf0.001 in files of at most 100 rows."""
    return export.export_sorted(catalog.unified(spark, "/root/testdata/sf0.001"), str(tmp_path_factory.mktemp("pub") / "pub"), file_rows=100)


@pytest.mark.parametrize("fused_bytes", [1, 60_000, 1 << 40])
def test_fusion_keeps_the_order_within_and_across_files(spark, small_files, tmp_path, fused_bytes):
    out = export.export_fusion(spark, small_files, str(tmp_path / "fused"), fused_bytes=fused_bytes)
    files = sorted(f for f in os.listdir(out) if f.endswith(".parquet"))
    source = export.ordered_files(spark, small_files)
    assert len(files) == {1: len(source), 1 << 40: 1}.get(fused_bytes, len(files)) and (fused_bytes > 1 << 30 or len(files) > 3)
    keys = [_key(r) for f in files for r in pq.read_table(f"{out}/{f}", columns=KEYS).to_pylist()]
    assert keys == sorted(keys)
    back, pub = spark.read.parquet(out), read_published(spark, small_files)
    assert back.schema == pub.schema and back.exceptAll(pub).count() == 0 and pub.exceptAll(back).count() == 0


def test_fusion_of_many_tasks_and_of_nothing(spark, tmp_path):
    feats = unify.unified_features({"parcelles": spark.range(4000).select(F.concat(F.lpad((F.col("id") % 95 + 1).cast("string"), 2, "0"), F.lit("001")).alias("commune"), F.col("id").cast("string").alias("id"))})
    path = export.export_sorted(feats, str(tmp_path / "pub"), file_rows=50)
    listed = export.ordered_files(spark, path)
    assert [x[0] for x in listed] == sorted(x[0] for x in listed) and len(listed) > 80
    out = export.export_fusion(spark, path, str(tmp_path / "fused"), fused_bytes=20_000)
    deps = [r for f in sorted(os.listdir(out)) if f.endswith(".parquet") for r in pq.read_table(f"{out}/{f}", columns=["lot", "departement"]).to_pylist()]
    assert len(deps) == 4000 and deps == sorted(deps, key=lambda r: (r["lot"], r["departement"]))
    none = export.export_sorted(feats.limit(0), str(tmp_path / "none"))
    os.makedirs(none, exist_ok=True)
    assert spark.read.parquet(export.export_fusion(spark, none, str(tmp_path / "nothing"))).count() == 0


def test_curve_keeps_neighbours_together(spark):
    pts = spark.range(64).select((F.col("id") % 8 * 8).alias("x"), (F.floor(F.col("id") / 8) * 8).alias("y"))
    got = [(r["x"], r["y"]) for r in pts.orderBy(curve_key(F.col("x"), F.col("y"))).collect()]
    want = sorted(((8 * x, 8 * y) for x in range(8) for y in range(8)), key=lambda p: sum(((p[0] // 8 >> b & 1) << 2 * b) + ((p[1] // 8 >> b & 1) << 2 * b + 1) for b in range(3)))
    assert got == want
    odd = spark.createDataFrame([(-5.0, 1e12), (None, 3.0), (1e12, -1e12)], "x double, y double").select(curve_key(F.col("x"), F.col("y")).alias("k"))
    assert [r["k"] is None for r in odd.collect()] == [False, True, False]


def test_curve_interleaves_all_bits_and_names_each_coordinate_a_few_times(spark):
    at = [-(1 << 23), -70_001, -1, 0, 1, 12_345, 5_592_405, (1 << 23) - 1]
    cells = [(x, y) for x in at for y in at]
    got = spark.createDataFrame([(8.0 * x, 8.0 * y + 7.5) for x, y in cells], "x double, y double").select("x", "y", curve_key(F.col("x"), F.col("y")).alias("k"))
    want = {(8.0 * x, 8.0 * y + 7.5): sum(((x + (1 << 23) >> b & 1) << 2 * b) + ((y + (1 << 23) >> b & 1) << 2 * b + 1) for b in range(24)) for x, y in cells}
    assert {(r["x"], r["y"]): r["k"] for r in got.collect()} == want
    plan = spark.range(1).select(F.rand(1).alias("xx"), F.rand(2).alias("yy")).select(curve_key(F.col("xx"), F.col("yy")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("xx#") <= 4 and plan.count("yy#") <= 4  # once for the key, once for null, once where it is made


def test_staged_curve_key_equals_the_expression(spark):
    """Cells of all bits, both sides of zero, beyond the plane, null and not a number; no step is repeated in the plan."""
    at = [8.0 * c + 3 for c in (-(1 << 23), -70_001, -1, 0, 1, 12_345, 5_592_405, (1 << 23) - 1)] + [1e12, -1e12, None]
    d = spark.createDataFrame([(x, y) for x in at for y in at], "x double, y double")
    got = with_curve_key(d, "k", F.col("x"), F.col("y"))
    assert got.columns == ["x", "y", "k"]
    assert got.where(~F.col("k").eqNullSafe(curve_key(F.col("x"), F.col("y")))).count() == 0 and got.where("k IS NULL").count() == 21
    feats = catalog.unified(spark, "/root/testdata/sf0.001")
    plan = export._with_sort_keys(export.assign_lots(feats), True)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" not in plan and len(plan) < 5 * len(feats._jdf.queryExecution().optimizedPlan().toString())


def test_one_place_is_compact_in_its_files(spark, tmp_path):
    """A commune of 20,000 features on a square: each file's zone covers a small part of it."""
    at = lambda c: F.col(c).cast("float")
    hot = spark.range(20000).select(F.lit("59350").alias("commune"), F.col("id").cast("string").alias("id"), F.lit("AB").alias("section"),
                                    (F.xxhash64("id") % 4000).alias("x"), (F.xxhash64("id", F.lit(1)) % 4000).alias("y"))
    hot = hot.select("commune", "id", "section", F.struct(at("x").alias("xmin"), at("y").alias("ymin"), (at("x") + 1).alias("xmax"), (at("y") + 1).alias("ymax")).alias("geometry_bbox"))
    path = export.export_sorted(unify.unified_features({"parcelles": hot}), str(tmp_path / "hot"), file_rows=500)
    z = export.read_zones(spark, path).select((F.col("xmax") - F.col("xmin")).alias("w"), (F.col("ymax") - F.col("ymin")).alias("h"), "n").collect()
    assert len(z) >= 40 and sum(r["n"] for r in z) == 20000
    assert sum(r["w"] * r["h"] for r in z) < 3 * 8000**2
    got = extract.read_extent(spark, path, 100, 100, 300, 300, 2154)
    assert 0 < len(got.inputFiles()) < len(z) / 4
    assert rows(got, "id") == rows(extract.extract_extent(read_published(spark, path), 100, 100, 300, 300, 2154), "id")


def test_extent_reads_only_files_it_meets(spark, small_files):
    pub = read_published(spark, small_files)
    n = len(pub.inputFiles())
    assert n > 50
    got = extract.read_extent(spark, small_files, 0, 0, 350, 120, 2154)
    zones = export.read_zones(spark, small_files).where("xmax >= 0 AND xmin <= 350 AND ymax >= 0 AND ymin <= 120 AND geom_srid = 2154")
    assert len(got.inputFiles()) == zones.select("lot", "file").distinct().count() < n / 2
    want = extract.extract_extent(pub, 0, 0, 350, 120, 2154)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    assert extract.read_extent(spark, small_files, -50, -50, -40, -40).count() == 0


def test_windows_in_opposite_corners_read_few_files(spark, small_files):
    windows = spark.createDataFrame([(1, 0.0, 0.0, 220.0, 90.0, 2154), (2, 9700.0, 0.0, 9990.0, 90.0, 2154)], "extent_id long, xmin double, ymin double, xmax double, ymax double, srid int")
    got = extract.read_many_extents(spark, small_files, windows)
    assert len(got.inputFiles()) < len(read_published(spark, small_files).inputFiles()) / 3
    want = extract.extract_many_extents(read_published(spark, small_files), windows)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


@pytest.mark.parametrize("match_srid", [True, False])
def test_pruned_extents_equal_the_plain_join(spark, sf, small_files, match_srid):
    """Wide, small, nested, equal, empty-handed and degenerate windows, over files they hold whole, cut or miss."""
    more = spark.createDataFrame([(100, 0.0, 0.0, 1e5, 1e5, 2154), (101, 0.0, 0.0, 1e5, 1e5, 2975), (102, 150.0, 50.0, 150.0, 50.0, 2154), (103, -9.0, -9.0, -1.0, -1.0, 2154),
                                  (100, 0.0, 0.0, 1e5, 1e5, 2154), (104, 90.0, 0.0, 410.0, 100.0, None), (None, 0.0, 0.0, 300.0, 300.0, 2154)], "extent_id long, xmin double, ymin double, xmax double, ymax double, srid int")
    windows = catalog.extents(spark, sf).unionByName(more)
    got = extract.read_many_extents(spark, small_files, windows, base=70.0, match_srid=match_srid)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    want = extract.extract_many_extents(read_published(spark, small_files), windows, match_srid=match_srid)
    cols = ["extent_id", "type_objet", "id", "geom_srid", "lot"]
    assert rows(got, *cols) == rows(want, *cols)
    assert extract.read_many_extents(spark, small_files, windows.limit(0)).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, sf, tmp_path):
    names = unify.save_bucketed_tables(catalog.A.layers(spark, sf), str(tmp_path), "bt_", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalog.commune_counts(spark, "bt_")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
        plain = {n: spark.table(f"bt_{n}").count() for n in ("parcelles", "batiments")}
        assert plain == {n: catalog.A.layer(spark, sf, n).count() for n in plain} and got.count() > 0 and len(names) == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_a_hot_commune_of_a_layer_table_is_split(spark):
    from parcelflow.operators.enrich import enrich_layer, sort_layer

    hot = spark.range(20000).select(F.lit("59350").alias("commune"), F.col("id").cast("string").alias("id"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sort_layer(enrich_layer(hot, "sections")).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert max(r["count"] for r in sizes) < 10000 and sum(r["count"] for r in sizes) == 20000


def test_buckets_grow_with_the_files_of_the_largest_layer(spark, sf, tmp_path, monkeypatch):
    few = unify.buckets_for(spark, [spark.range(10).write.parquet(str(tmp_path / "a")) or str(tmp_path / "a")])
    spark.range(100_000).repartition(4).write.parquet(str(tmp_path / "b"))
    size = sum(f.stat().st_size for f in (tmp_path / "b").iterdir() if f.suffix == ".parquet")
    many = unify.buckets_for(spark, [str(tmp_path / "a"), str(tmp_path / "b")], 10_000)
    assert few == 16 and size // 10_000 <= many <= size // 10_000 + 2
    want = rows(catalog.queries()["layer_join"](spark, sf))
    monkeypatch.setattr(unify, "BUCKET_BYTES", 4_000)
    wide = catalog.queries()["layer_join"](spark, sf)
    assert rows(wide) == want and " out of 16" not in wide._jdf.queryExecution().toString()


def test_order_checks_tell_files_apart_without_their_paths(spark, tmp_path):
    for k, values in enumerate(([1, 3, 2, 4], [5, 4], [9])):
        spark.createDataFrame([("p", v) for v in values], "part string, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "d" / f"k={k}"))
    d = spark.read.parquet(str(tmp_path / "d"))
    got = catalog.out_of_order(d, [F.col("v")])
    assert [tuple(r) for r in got.collect()] == [("p", 7, 2)]
    assert "xxhash64(" in got._jdf.queryExecution().optimizedPlan().toString()
    for k, (a, b) in enumerate([(1, 4), (3, 9), (9, 9)]):
        spark.createDataFrame([(v,) for v in (a, 100, b)], "v int").coalesce(1).write.parquet(str(tmp_path / f"n{k}"))
        part = next(f for f in (tmp_path / f"n{k}").iterdir() if f.suffix == ".parquet")
        (tmp_path / "e").mkdir(exist_ok=True)
        (tmp_path / "e" / f"part-{k}.parquet").write_bytes(part.read_bytes())
    between = catalog.out_of_order_between(spark.read.parquet(str(tmp_path / "e")), [F.col("v")])
    assert [tuple(r) for r in between.collect()] == [(1,)]
    assert "Join" in between._jdf.queryExecution().optimizedPlan().toString()


def test_layer_files_are_written_layer_by_layer(spark, sf):
    root = fixtures.layer_files(spark, sf).removeprefix("file:")
    for name in schema.LAYERS:
        want = catalog.A.layer(spark, sf, name, with_geometry=True)
        file = next(f for f in os.listdir(f"{root}/layer={name}") if f.endswith(".parquet"))
        assert pq.read_schema(f"{root}/layer={name}/{file}").names == want.columns  # not those of all layers
        back = spark.read.schema(want.schema).parquet(f"{root}/layer={name}")
        assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()


def test_export_takes_tasks_by_the_size_of_its_files(spark, sf, tmp_path, monkeypatch):
    feats = catalog.unified(spark, sf)
    plain = export.export_sorted(feats, str(tmp_path / "plain"))
    monkeypatch.setattr(export, "SORT_BYTES", 10_000)
    path = export.export_sorted(feats, str(tmp_path / "many"))
    files = export.ordered_files(spark, path)
    assert len({f.rsplit("part-", 1)[1][:5] for _, f, _ in files}) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [_key(r) for lot, f, _ in files for r in pq.ParquetFile(f.removeprefix("file:")).read(columns=KEYS[1:]).append_column("lot", [[lot] * pq.read_metadata(f.removeprefix("file:")).num_rows]).to_pylist()]
    assert keys == sorted(keys) and len(keys) > 0
    a, b = read_published(spark, plain), read_published(spark, path)
    assert a.count() == len(keys) and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_export_key_orders_as_its_parts_in_one_string(spark):
    said = [None, "", "\x00", "\x00\x00", "\x01", "\x01\x01", "\x02", "0", "0\x00", "0\x01", "00", "5", "59", "59\x00a", "59\x01", "é", "\uffff", "\U0001f600"]
    parts = [(d, c, t, s) for d in said for c in said for t in ("a", None) for s in ("", None, "\x00")]
    order = lambda r: tuple((v is None, (v or "").encode()) for v in r)
    d = spark.createDataFrame(parts, "d string, c string, t string, s string").repartition(3)
    got = d.orderBy(export._as_one(*(F.col(x) for x in "dcts"))).collect()
    assert [order(r) for r in got] == sorted(order(r) for r in parts)


def test_export_compares_one_string_and_sorts_once(spark, sf, tmp_path):
    feats = catalog.unified(spark, sf)
    keyed, keys = export._with_sort_keys(export.assign_lots(feats), True)
    assert [k for k in keyed.columns if k not in (*feats.columns, "lot")] == ["_key", "_curve", "_tb"] and len(keys) == 3
    places = [r[0] for r in keyed.where("lot is not null").groupBy("lot").agg(F.min("_key").alias("k")).orderBy("k").collect()]
    assert places == sorted(places) and len(places) == len(schema.LOT_NAMES)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with export._writers(spark, 9):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "9"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_layers_are_written_beside_each_other(spark):
    both = threading.Barrier(2)  # each write waits for the other
    fixtures._at_once(spark, lambda name: both.wait(timeout=30), ("communes", "sections"))

    def fails(name):
        raise ValueError(name)

    with pytest.raises(ValueError, match="sections"):
        fixtures._at_once(spark, fails, ("sections",))
    fixtures._at_once(spark, fails, ())


def _shuffled(spark) -> int:
    """Files of shuffles in the local folders of the session's executors (here the driver)."""
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    return sum(f.startswith("shuffle_") for d in dirs for _, _, names in os.walk(d) for f in names)


def test_a_large_export_goes_batch_by_batch_and_leaves_only_its_files(spark, sf, tmp_path, monkeypatch):
    feats = catalog.unified(spark, sf)
    plain = read_published(spark, export.export_sorted(feats, str(tmp_path / "plain")))
    monkeypatch.setattr(export, "STAGED_BYTES", 1)
    shared, before = shared_dir(spark).removeprefix("file:"), _shuffled(spark)
    path = export.export_sorted(feats, str(tmp_path / "staged"))
    assert _shuffled(spark) <= before + 8  # those of the zone table, one task a file at most; none of the rows
    assert not [n for n in os.listdir(shared) if n.startswith("export-batches")]
    staged = read_published(spark, path)
    assert plain.count() > 0 and plain.exceptAll(staged).count() == 0 and staged.exceptAll(plain).count() == 0
    keys = [_key({**r, "lot": lot}) for lot, f, _ in export.ordered_files(spark, path) for r in pq.ParquetFile(f.removeprefix("file:")).read(columns=KEYS[1:]).to_pylist()]
    assert keys == sorted(keys) and len(keys) == plain.count()
    zones = {tuple(r) for r in export.read_zones(spark, path).groupBy("lot", "geom_srid").agg(F.sum("n")).collect()}
    assert zones == {tuple(r) for r in export.read_zones(spark, str(tmp_path / "plain")).groupBy("lot", "geom_srid").agg(F.sum("n")).collect()}
    # again over it, twice, some batches only, and from features that hold their batch
    export.export_sorted(feats, path)
    assert read_published(spark, path).count() == plain.count()
    export.export_sorted(feats, path, mode="append")
    assert read_published(spark, path).count() == 2 * plain.count()
    export.export_sorted(feats, path, lots=["01_10", "2A_2B"])
    n = {r["lot"]: r["count"] for r in plain.groupBy("lot").count().collect()}
    assert {r["lot"]: r["count"] for r in read_published(spark, path).groupBy("lot").count().collect()} == {k: v * (1 if k in ("01_10", "2A_2B") else 2) for k, v in n.items()}
    export.export_sorted(plain, str(tmp_path / "batched"), batched=True)
    batched = read_published(spark, str(tmp_path / "batched"))
    assert plain.exceptAll(batched).count() == 0 and batched.exceptAll(plain).count() == 0
    none = export.export_sorted(feats.where("departement = 'none'"), str(tmp_path / "none"))
    assert not [d for d in os.listdir(none) if d.startswith("lot=")] if os.path.exists(none) else True


def test_extents_shuffle_no_whole_rows(spark, small_files):
    windows = spark.createDataFrame([(i, 100.0 * i + 30, 130.0, 100.0 * i + 150, 460.0, 2154) for i in range(6)], "extent_id bigint, xmin double, ymin double, xmax double, ymax double, srid int")
    got = extract.read_many_extents(spark, small_files, windows)
    want = extract.extract_many_extents(read_published(spark, small_files), windows).select(got.columns)
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
    physical = got._jdf.queryExecution().executedPlan().toString().split("\n")
    for k, line in enumerate(physical):  # what goes into an exchange holds no geometry
        if "Exchange hashpartitioning" in line:
            below = next(x for x in physical[k + 1:] if "Project" in x or "Scan" in x)
            assert "geometry#" not in below.split("[", 1)[1]
