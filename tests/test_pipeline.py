"""Layer enrichment, union, export and extracts (sf0.001 tables)."""

import os
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from parcelflow import schema as S
from parcelflow.functions.codes import routable
from parcelflow.operators import enrich, export, extract, unify
from parcelflow.plans import adapters as A
from parcelflow.plans import catalog
from parcelflow.sources.layers import read_layer, read_published
from conftest import rows


def test_union_is_bag_sum_and_split_is_exhaustive(spark, sf):
    layers = A.layers(spark, sf)
    total = sum(df.count() for df in layers.values())
    assert unify.unified_features(layers).count() == total
    located, unlocated = enrich.split_subdivisions(layers["subdivisions_fiscales"])
    assert located.count() + unlocated.count() == layers["subdivisions_fiscales"].count()
    assert unlocated.where("departement = '000' AND commune = '00000'").count() == unlocated.count()
    conformed = unify.conform(unify.union_layers([enrich.enrich_layer(layers["communes"], "communes")]))
    assert [(f.name, f.dataType) for f in conformed.schema] == [(f.name, f.dataType) for f in S.CANONICAL]


def test_enrich_mixed_equals_per_layer(spark, sf):
    layers = A.layers(spark, sf)
    per_layer = catalog.flat(unify.unified_features(layers))
    tagged = [df.withColumn("layer", F.lit(n)) for n, df in layers.items()]
    mixed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    for f in S.ATTRIBUTES.fields:
        if f.name not in mixed.columns:
            mixed = mixed.withColumn(f.name, F.lit(None).cast(f.dataType))
    via_mixed = catalog.flat(unify.conform(enrich.enrich_mixed(mixed)))
    assert per_layer.exceptAll(via_mixed).count() == 0 and via_mixed.exceptAll(per_layer).count() == 0


def test_read_layer_glob_any_depth_and_missing_column(spark, tmp_path):
    d1, d2 = tmp_path / "dep59" / "x", tmp_path / "dep2A"
    os.makedirs(d1), os.makedirs(d2)
    pq.write_table(pa.table({"id": ["59350"], "nom": ["Lille"]}), d1 / "communes.parquet")
    pq.write_table(pa.table({"id": ["2A004"]}), d2 / "communes.parquet")
    pq.write_table(pa.table({"commune": ["59350"], "code": ["AB"]}), d2 / "sections.parquet")
    df = read_layer(spark, str(tmp_path), "communes")
    assert rows(df, "id", "nom") == [("2A004", None), ("59350", "Lille")]
    feats = unify.unified_features({"communes": df})
    assert rows(feats, "departement", "commune", "geom_srid") == [("2A", "2A004", 2154), ("59", "59350", 2154)]
    assert read_layer(spark, str(tmp_path), "sections").count() == 1


def test_duplicates_are_kept(spark):
    a = spark.createDataFrame([("59350", "A")], "commune string, section string")
    feats = unify.unified_features({"sections": a, "feuilles": a})
    assert feats.count() == 2


def test_export_sorted_batches(spark, sf, tmp_path):
    feats = catalog.unified(spark, sf)
    odd = spark.createDataFrame([("ZZ001",), (None,)], "commune string")
    feats = feats.unionByName(unify.unified_features({"sections": odd}))
    path = export.export_sorted(feats, str(tmp_path / "pub"))
    pub = read_published(spark, path)
    assert pub.count() == feats.where(routable("departement")).count()
    assert export.unrouted(feats).count() == 2
    # batches are disjoint and each holds exactly its départements
    from parcelflow.functions.codes import lot_of
    assert pub.where(lot_of("departement") != F.col("lot")).count() == 0
    # every file is sorted by (departement, commune, type prefix, section), NULLs last
    key = lambda r: tuple((v is None, v or "") for v in (r[0], r[1], r[2][:8], r[3]))
    for lot in S.LOT_NAMES:
        d = tmp_path / "pub" / f"lot={lot}"
        if not d.exists():
            continue
        for f in sorted(os.listdir(d)):
            if f.endswith(".parquet"):
                t = pq.read_table(d / f, columns=["departement", "commune", "type_objet", "section"]).to_pylist()
                ks = [key((r["departement"], r["commune"], r["type_objet"], r["section"])) for r in t]
                assert ks == sorted(ks), f"{lot}/{f} not sorted"


def test_extract_plans_prune_and_push(spark, sf):
    pub = catalog.published(spark, sf)
    df = extract.extract_commune(pub, "59000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lot" in plan and "56_70" in plan
    assert "PushedFilters: [IsNotNull(commune), EqualTo(commune,59000)]" in plan
    assert rows(df, "commune")[0] == ("59000",) and df.exceptAll(pub).count() == 0
    box = extract.extract_extent(pub, 0, 0, 500, 500, 2154)
    bplan = box._jdf.queryExecution().executedPlan().toString()
    assert "geometry_bbox.xmax" in bplan and "PushedFilters" in bplan


def test_many_extents_match_brute_force(spark, sf):
    pub = catalog.published(spark, sf)
    ext = catalog.extents(spark, sf)
    got = extract.extract_many_extents(pub, ext, base=70.0)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    few = extract.extract_many_extents(pub, ext.where("extent_id = 0"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(geometry_bbox.xmin,2500.0)" in plan and "GreaterThanOrEqual(geometry_bbox.ymax,0.0)" in plan
    f = pub.select("type_objet", "id", "geom_srid", "geometry_bbox.*").toPandas()
    e = ext.toPandas()
    brute = []
    for er in e.itertuples():
        hit = f[(f.xmax >= er.xmin) & (f.xmin <= er.xmax) & (f.ymax >= er.ymin) & (f.ymin <= er.ymax)
                & (f.geom_srid == er.srid)]
        brute += [(er.extent_id, t, i) for t, i in zip(hit.type_objet, hit.id)]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(rows(got, "extent_id", "type_objet", "id"), key=key) == sorted(brute, key=key)


def test_backfill(spark):
    feats = unify.unified_features({
        "sections": spark.createDataFrame([("59350", "AB", None)], "commune string, code string, section string"),
        "parcelles": spark.createDataFrame([("59350", "59350000AB0001")], "commune string, id string"),
    })
    got = rows(unify.backfill_section_parcelle(feats), "type_objet", "section", "parcelle")
    assert got == [("parcelles", None, "59350000AB0001"), ("sections", "AB", None)]


def test_fusion_and_extract_sinks(spark, sf, tmp_path):
    pub = catalog.published(spark, sf)
    fused = export.export_fusion(spark, catalog.publish(spark, sf), str(tmp_path / "fusion"))
    back = spark.read.parquet(fused)
    assert back.exceptAll(pub).count() == 0 and back.count() == pub.count()
    out = export.export_extract(extract.extract_commune(pub, "59000"), str(tmp_path / "lille"), single_file=True)
    assert spark.read.parquet(out).count() == extract.extract_commune(pub, "59000").count()
    from parcelflow.sources.pages import read_pages
    assert read_pages(spark, f"{sf}/pages.parquet").count() > 0


def test_export_splits_a_hot_commune_over_tasks(spark, tmp_path):
    """One commune holding every row still spreads over several sorted files."""
    hot = spark.range(20000).select(F.lit("59350").alias("commune"),
                                    F.concat(F.lit("59350000AB"), F.col("id").cast("string")).alias("id"),
                                    F.lit("AB").alias("section"))
    feats = unify.unified_features({"parcelles": hot})
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = export.export_sorted(feats, str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    d = tmp_path / "hot" / "lot=56_70"
    files = sorted(f for f in os.listdir(d) if f.endswith(".parquet"))
    assert len(files) > 1, "a hot key must not land in a single task"
    sizes = [pq.read_metadata(d / f).num_rows for f in files]
    assert sum(sizes) == 20000 and max(sizes) < 20000 * 0.5
    assert read_published(spark, path).count() == 20000
    fused = export.export_fusion(spark, path, str(tmp_path / "fused"), fused_bytes=max(os.path.getsize(d / f) for f in files))
    parts = [f for f in os.listdir(fused) if f.endswith(".parquet")]
    assert len(parts) > 1, "the fusion must not put a hot key into one task"


def test_adapters_use_every_row(spark, sf):
    for layer, table in (("communes", "customer"), ("prefixes_sections", "part"), ("sections", "part"), ("subdivisions_fiscales", "lineitem"),
                         ("parcelles", "lineitem"), ("feuilles", "orders"), ("batiments", "orders"), ("lieux_dits", "supplier")):
        assert A.layer(spark, sf, layer).count() == A.table(spark, sf, table).count()
    big = "/root/testdata/sf0.1"
    assert A.layer(spark, big, "communes").count() == A.table(spark, big, "customer").count() > A.N_COMMUNE_KEYS
    assert A.link_edges(spark, sf).count() == 2 * A.table(spark, sf, "part").count()


def test_nine_tables_six_sorted(spark, sf, tmp_path):
    names = unify.save_layer_tables(A.layers(spark, sf), str(tmp_path))
    assert len(names) == 9 and S.UNLOCATED_TABLE in names and len(S.SORTED_TABLES) == 6
    assert sum(spark.read.parquet(str(tmp_path / n)).count() for n in names) == sum(d.count() for d in A.layers(spark, sf).values())
