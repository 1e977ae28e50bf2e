"""Query catalogue: each entry is a Spark job over the driver tables plus,
where SQL can express it, the DuckDB oracle computing the same rows.

Oracle outputs omit geometry bytes (but for ``layer_geometry``) and flatten
``geometry_bbox`` into four DOUBLE columns (``bbox_xmin`` ...); the Spark side
applies :func:`flat` to the operator's output for the same shape.  The SQL of
links, paths and manifests is written in its own terms, not with the
operators' patterns.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.codes import departement_of, type_prefix
from ..functions.geometry import rings_of
from ..operators import enrich, export, extract, inventory, links, manifest, spatial, unify
from ..session import app_id, discard, scratch_path, ship_package
from ..sinks.layers import write_layer_file
from ..sources.files import list_files
from ..sources.log_store import LogStore
from ..sources.layers import PUBLISHED, read_batches, read_layer, read_layers, read_published
from ..sources.manifest import read_log, read_manifest, write_log
from ..sources.pages import read_pages
from ..streaming import incremental
from . import adapters as A
from . import fixtures as FX

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # executors need the package for UDFs
            return fn(spark, sf_dir)
        shipped.__name__ = fn.__name__
        _QUERIES[name] = shipped
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ------------------------------------------------------------- shaping ----

BBOX_FLAT = ("bbox_xmin", "bbox_ymin", "bbox_xmax", "bbox_ymax")


def flat(df: DataFrame) -> DataFrame:
    """Drop geometry bytes, flatten the bbox struct to four DOUBLE columns."""
    cols = [F.col(c) for c in df.columns if c not in ("geometry", "geometry_bbox")]
    if "geometry_bbox" in df.columns:
        cols += [F.col(f"geometry_bbox.{p}").cast("double").alias(f"bbox_{p}")
                 for p in ("xmin", "ymin", "xmax", "ymax")]
    return df.select(*cols)


def flat_sql(src: str) -> str:
    parts = ", ".join(f"CAST(geometry_bbox.{p} AS DOUBLE) AS bbox_{p}" for p in ("xmin", "ymin", "xmax", "ymax"))
    return f"SELECT * EXCLUDE (geometry_bbox), {parts} FROM ({src})"


# ------------------------------------------------------- SQL fragments ----

def dep_of_sql(c: str) -> str:
    return f"CASE WHEN left({c}, 2) != '97' THEN left({c}, 2) WHEN left({c}, 2) = '97' THEN left({c}, 3) END"


def srid_sql(mode: str = "literal") -> str:
    head = "WHEN departement = '000' THEN 0 " if mode == "documented" else ""
    return ("CASE " + head +
            "WHEN departement NOT IN ('971', '972', '973', '974', '976', '00') THEN 2154 "
            "WHEN departement IN ('971', '972') THEN 5490 WHEN departement = '973' THEN 2972 "
            "WHEN departement = '974' THEN 2975 WHEN departement = '976' THEN 4471 END")


def lot_sql(c: str = "departement") -> str:
    n = f"TRY_CAST({c} AS INTEGER)"
    return (f"CASE WHEN {c} IN ('2A', '2B') THEN '2A_2B' WHEN {n} <= 10 THEN '01_10' "
            f"WHEN {n} <= 25 THEN '11_25' WHEN {n} <= 40 THEN '26_40' WHEN {n} <= 55 THEN '41_55' "
            f"WHEN {n} <= 70 THEN '56_70' WHEN {n} <= 85 THEN '71_85' WHEN {n} <= 95 THEN '86_95' "
            f"WHEN {n} > 95 THEN '971_976' END")


def enriched_sql(name: str, millesime: str = S.DEFAULT_MILLESIME) -> str:
    raw = f"({A.layer_sql(name)})"
    m = f"'{millesime}' AS millesime"
    if name == "communes":
        return f"SELECT {m}, {dep_of_sql('id')} AS departement, id AS commune, 'communes' AS type_objet, * FROM {raw}"
    if name == "subdivisions_fiscales":  # the two published branches
        return (f"SELECT {m}, {dep_of_sql('parcelle')} AS departement, left(parcelle, 5) AS commune, "
                f"'subdivisions_fiscales' AS type_objet, * FROM {raw} WHERE parcelle IS NOT NULL "
                f"UNION ALL BY NAME "
                f"SELECT {m}, '000' AS departement, '00000' AS commune, 'subdivisions_fiscales' AS type_objet, * "
                f"FROM {raw} WHERE parcelle IS NULL")
    return f"SELECT {m}, {dep_of_sql('commune')} AS departement, '{name}' AS type_objet, * FROM {raw}"


def unified_sql(srid_mode: str = "literal") -> str:
    union = " UNION ALL BY NAME ".join(f"SELECT * FROM ({enriched_sql(n)})" for n in S.UNION_ORDER)
    cols = []
    for f in S.CANONICAL.fields:
        if f.name == "millesime":
            cols.append("CAST(millesime AS DATE) AS millesime")
        elif f.name == "geom_srid":
            cols.append(f"CAST({srid_sql(srid_mode)} AS INTEGER) AS geom_srid")
        elif f.name == "geometry":
            continue
        else:
            cols.append(f'"{f.name}"')
    return f"SELECT {', '.join(cols)} FROM ({union})"


UNIFIED_FLAT_SQL = flat_sql(unified_sql())


_UNIFIED: dict[tuple[str, str, str], DataFrame] = {}


def unified(spark: SparkSession, sf_dir: str, srid_mode: str = "literal") -> DataFrame:
    """Canonical features from the layer files derived from ``sf_dir``.

    The (immutable) plan is built once per session and reused; building it
    costs hundreds of driver-JVM calls, running it is unaffected."""
    key = (app_id(spark), sf_dir, srid_mode)
    if key not in _UNIFIED:
        _UNIFIED[key] = unify.unified_features(
            read_layers(spark, FX.layer_files(spark, sf_dir), layout="partitioned"), srid_mode=srid_mode)
    return _UNIFIED[key]


# ---------------------------------------------------------- layer jobs ----

def _layer_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(enrich.enrich_layer(A.layer(spark, sf_dir, name), name))
    run.__name__ = f"layer_{name}"
    return run


for _name in ("communes", "parcelles", "batiments", "sections", "feuilles", "lieux_dits", "prefixes_sections"):
    register(f"layer_{_name}", flat_sql(enriched_sql(_name)))(_layer_query(_name))


_SUBDIV_SQL = enriched_sql("subdivisions_fiscales")


@register("subdivisions_located", flat_sql(f"SELECT * FROM ({_SUBDIV_SQL}) WHERE parcelle IS NOT NULL"))
def q_subdivisions_located(spark, sf_dir):
    located, _ = enrich.split_subdivisions(A.layer(spark, sf_dir, "subdivisions_fiscales"))
    return flat(located)


@register("subdivisions_unlocated", flat_sql(f"SELECT * FROM ({_SUBDIV_SQL}) WHERE parcelle IS NULL"))
def q_subdivisions_unlocated(spark, sf_dir):
    _, unlocated = enrich.split_subdivisions(A.layer(spark, sf_dir, "subdivisions_fiscales"))
    return flat(unlocated)


@register("unified_features", UNIFIED_FLAT_SQL)
def q_unified_features(spark, sf_dir):
    return flat(unified(spark, sf_dir))


@register("srid_by_departement",
          f"SELECT departement, geom_srid, count(*) AS n FROM ({unified_sql()}) GROUP BY departement, geom_srid")
def q_srid_by_departement(spark, sf_dir):
    return unified(spark, sf_dir).groupBy("departement", "geom_srid").agg(F.count("*").alias("n"))


@register("srid_documented",
          f"SELECT departement, geom_srid, count(*) AS n FROM ({unified_sql('documented')}) "
          f"GROUP BY departement, geom_srid")
def q_srid_documented(spark, sf_dir):
    return (unified(spark, sf_dir, srid_mode="documented")
            .groupBy("departement", "geom_srid").agg(F.count("*").alias("n")))


@register("lot_assignment",
          f"SELECT type_objet, id, departement, commune, {lot_sql()} AS lot FROM ({unified_sql()})")
def q_lot_assignment(spark, sf_dir):
    return export.assign_lots(unified(spark, sf_dir)).select("type_objet", "id", "departement", "commune", "lot")


@register("lot_counts",
          f"SELECT lot, count(*) AS n, count(DISTINCT departement) AS n_departements "
          f"FROM (SELECT departement, {lot_sql()} AS lot FROM ({unified_sql()})) GROUP BY lot")
def q_lot_counts(spark, sf_dir):
    return (export.assign_lots(unified(spark, sf_dir)).groupBy("lot")
            .agg(F.count("*").alias("n"), F.countDistinct("departement").alias("n_departements")))


@register("layer_counts", f"SELECT type_objet, count(*) AS n FROM ({unified_sql()}) GROUP BY type_objet")
def q_layer_counts(spark, sf_dir):
    return unified(spark, sf_dir).groupBy("type_objet").agg(F.count("*").alias("n"))


@register("backfill_section_parcelle",
          f"SELECT type_objet, id, commune, "
          f"CASE WHEN type_objet = 'sections' THEN coalesce(section, code) ELSE section END AS section, "
          f"CASE WHEN type_objet = 'parcelles' THEN coalesce(parcelle, id) ELSE parcelle END AS parcelle "
          f"FROM ({unified_sql()})")
def q_backfill(spark, sf_dir):
    return unify.backfill_section_parcelle(unified(spark, sf_dir)).select(
        "type_objet", "id", "commune", "section", "parcelle")


# ------------------------------------------------------ export/extract ----

_PUBLISHED: dict[tuple[str, str], str] = {}
_COPIES: dict[tuple[str, str, str], str] = {}


def publish(spark: SparkSession, sf_dir: str) -> str:
    """Export the unified features of ``sf_dir`` once; the dataset's path."""
    key = (app_id(spark), sf_dir)
    if key not in _PUBLISHED:
        _PUBLISHED[key] = export.export_sorted(unified(spark, sf_dir), scratch_path(spark, "published"))
    return _PUBLISHED[key]


def fresh_copy(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """What ``write`` makes at a new place; the copy an earlier call made is deleted."""
    path, key = scratch_path(spark, name), (app_id(spark), sf_dir, name)
    write(path)
    if key in _COPIES:
        discard(spark, _COPIES[key])
    _COPIES[key] = path
    return path


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_published(spark, publish(spark, sf_dir))


_ROUTED_SQL = f"SELECT *, {lot_sql()} AS lot FROM ({UNIFIED_FLAT_SQL})"


@register("export_sorted", f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL")
def q_export_sorted(spark, sf_dir):
    path = fresh_copy(spark, sf_dir, "export", lambda p: export.export_sorted(unified(spark, sf_dir), p))
    return flat(read_published(spark, path))


@register("export_fusion", f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL")
def q_export_fusion(spark, sf_dir):
    path = fresh_copy(spark, sf_dir, "fusion", lambda p: export.export_fusion(spark, publish(spark, sf_dir), p))
    return flat(spark.read.schema(PUBLISHED).parquet(path))


def out_of_order(df: DataFrame, keys: list) -> DataFrame:
    """Rows of a written dataset, and neighbours in its files that are out of order, by ``part``.

    Files are told apart by a hash of their paths, so that no path is shuffled or
    compared for a row; rows of two files with one hash would never hide a pair out of order.
    """
    key = F.struct(*[x for k in keys for x in (k.isNull(), k)])
    d = df.select("part", key.alias("k"), F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("k").over(Window.partitionBy("f").orderBy("i"))
    d = d.withColumn("bad", F.coalesce(before > F.col("k"), F.lit(False)))
    return d.groupBy("part").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_out_of_order"))


@register("export_order", f"SELECT lot AS part, count(*) AS n, 0 AS n_out_of_order FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL GROUP BY lot")
def q_export_order(spark, sf_dir):
    keys = [F.col("departement"), F.col("commune"), type_prefix("type_objet"), F.col("section")]
    return out_of_order(published(spark, sf_dir).withColumn("part", F.col("lot")), keys)


def out_of_order_between(df: DataFrame, keys: list) -> DataFrame:
    """Files of a written dataset, taken by name, that start before the file before them ends."""
    key = F.struct(*[x for k in keys for x in (k.isNull(), k)])
    d = df.select(key.alias("k"), F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    edges = d.groupBy("f").agg(F.min("i").alias("i0"), F.max("i").alias("i1"))
    at_edge = d.join(edges, "f").where("i = i0 OR i = i1")  # two rows a file, so that no other is sorted for them
    ends = at_edge.groupBy("f").agg(F.min_by("k", "i").alias("first"), F.max_by("k", "i").alias("last"))
    before = F.lag("last").over(Window.orderBy("f"))  # one row a file
    return ends.withColumn("bad", F.coalesce(before > F.col("first"), F.lit(False))).agg(F.count_if("bad").alias("n_out_of_order"))


@register("fusion_order",
          f"SELECT lot AS part, count(*) AS n, 0 AS n_out_of_order FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL GROUP BY lot "
          f"UNION ALL SELECT 'between files', count(*), 0 FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL")
def q_fusion_order(spark, sf_dir):
    """The fused files keep the batches' order, inside each file and from file to file by name."""
    # small runs: several files at any table size
    path = fresh_copy(spark, sf_dir, "fusion-order", lambda p: export.export_fusion(spark, publish(spark, sf_dir), p, fused_bytes=1 << 20))
    fused = spark.read.schema(PUBLISHED).parquet(path)
    keys = [F.col("lot"), F.col("departement"), F.col("commune"), type_prefix("type_objet"), F.col("section")]
    between = out_of_order_between(fused, keys).crossJoin(fused.agg(F.count("*").alias("n"))).select(F.lit("between files").alias("part"), "n", "n_out_of_order")
    return out_of_order(fused.withColumn("part", F.col("lot")), keys).unionByName(between)


@register("export_zones",
          f"SELECT lot, geom_srid, min(bbox_xmin) AS xmin, min(bbox_ymin) AS ymin, max(bbox_xmax) AS xmax, max(bbox_ymax) AS ymax, count(*) AS n "
          f"FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL AND bbox_xmin IS NOT NULL GROUP BY lot, geom_srid")
def q_export_zones(spark, sf_dir):
    """The zone table of the export's files, summed up by batch."""
    z = export.read_zones(spark, publish(spark, sf_dir))
    box = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    return z.groupBy("lot", "geom_srid").agg(*box, F.sum("n").alias("n"))


_TABLES_SQL = [f"SELECT '{n}' AS part, count(*) AS n, 0 AS n_out_of_order FROM ({A.layer_sql(n)}) "
               + ("WHERE parcelle IS NOT NULL" if n == "subdivisions_fiscales" else "") for n in S.LAYERS]
_TABLES_SQL.append(f"SELECT '{S.UNLOCATED_TABLE}', count(*), 0 FROM ({A.layer_sql('subdivisions_fiscales')}) WHERE parcelle IS NULL")


@register("layer_tables", " UNION ALL ".join(_TABLES_SQL))
def q_layer_tables(spark, sf_dir):
    """Nine tables written and read back; the six sorted ones are in order."""
    layers = read_layers(spark, FX.layer_files(spark, sf_dir), layout="partitioned")
    path = fresh_copy(spark, sf_dir, "tables", lambda p: unify.save_layer_tables(layers, p))

    def check(name: str) -> DataFrame:
        keys = [F.col("departement"), F.col("commune")] if name in S.SORTED_TABLES else [F.lit(0)]
        return out_of_order(spark.read.parquet(f"{path}/{name}").withColumn("part", F.lit(name)), keys)

    return reduce(DataFrame.unionByName, [check(n) for n in (*S.LAYERS, S.UNLOCATED_TABLE)])


@register("unified_view", f"SELECT type_objet, departement, count(*) AS n FROM ({unified_sql()}) GROUP BY type_objet, departement")
def q_unified_view(spark, sf_dir):
    layers = read_layers(spark, FX.layer_files(spark, sf_dir), layout="partitioned")
    union = unify.union_layers({n: enrich.enrich_layer(d, n) for n, d in layers.items()})
    unify.create_views(spark, union, unified(spark, sf_dir))
    return spark.sql("SELECT type_objet, departement, count(*) AS n FROM source_unique GROUP BY type_objet, departement")


@register("layer_by_name", flat_sql(f"SELECT * FROM ({A.layer_sql('sections')})"))
def q_layer_by_name(spark, sf_dir):
    """Every file named after the layer, at any depth, by the glob form; files of another name beside them are not read."""
    def write(root: str) -> None:
        for name in ("sections", "prefixes_sections"):
            FX.glob_tree(spark, sf_dir, name, root)

    root = fresh_copy(spark, sf_dir, "by-name", write)
    return flat(read_layer(spark, root, "sections", layout="glob").select(*A.layer(spark, sf_dir, "sections").columns))


_BUCKETED: dict[tuple[str, str], list[str]] = {}


@register("layer_join",
          f"SELECT commune, n_parcelles, surface, n_batiments FROM (SELECT commune, count(*) AS n_parcelles, CAST(sum(contenance) AS BIGINT) AS surface FROM ({A.layer_sql('parcelles')}) GROUP BY commune) "
          f"JOIN (SELECT commune, count(*) AS n_batiments FROM ({A.layer_sql('batiments')}) GROUP BY commune) USING (commune)")
def q_layer_join(spark, sf_dir):
    """Parcels and buildings by commune, from tables bucketed by commune."""
    key = (app_id(spark), sf_dir)
    for name in _BUCKETED.pop(key, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    prefix = f"layers_{abs(hash(key)) % 10**9}_"
    root = FX.layer_files(spark, sf_dir)
    layers, buckets = read_layers(spark, root, layout="partitioned"), unify.buckets_for(spark, [f"{root}/layer={n}" for n in S.LAYERS])
    fresh_copy(spark, sf_dir, "bucketed", lambda p: _BUCKETED.__setitem__(key, unify.save_bucketed_tables(layers, p, prefix, buckets)))
    return commune_counts(spark, prefix)


def commune_counts(spark: SparkSession, prefix: str) -> DataFrame:
    parcels = spark.table(f"{prefix}parcelles").groupBy("commune").agg(F.count("*").alias("n_parcelles"), F.sum("contenance").alias("surface"))
    return parcels.join(spark.table(f"{prefix}batiments").groupBy("commune").agg(F.count("*").alias("n_batiments")), "commune")


@register("layer_glob", flat_sql(f"SELECT * FROM ({A.layer_sql('sections')})"))
def q_layer_glob(spark, sf_dir):
    """A layer written as datasets named after it in several folders."""
    layer = A.layer(spark, sf_dir, "sections")

    def write(root: str) -> None:
        for k in range(3):
            part = layer.where(F.pmod(F.xxhash64("commune"), F.lit(3)) == k)
            write_layer_file(part, f"{root}/group{k}/sections.parquet", overwrite=True)

    root = fresh_copy(spark, sf_dir, "glob", write)
    folders = [read_layer(spark, f"{root}/group{k}", "sections", layout="dataset") for k in range(3)]
    return flat(reduce(DataFrame.unionByName, folders).select(*layer.columns))


@register("export_extract", f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL AND departement = '59'")
def q_export_extract(spark, sf_dir):
    rows = extract.extract_departement(read_batches(spark, publish(spark, sf_dir), ["56_70"]), "59")
    path = fresh_copy(spark, sf_dir, "extract", lambda p: export.export_extract(rows, p))
    return flat(spark.read.schema(PUBLISHED).parquet(path))


@register("layer_geometry", f"SELECT {A.commune_sql(A.ck_sql('c_custkey'))} AS id, CAST({A.commune_rings_sql(A.ck_sql('c_custkey'))} AS VARCHAR) AS rings FROM customer")
def q_layer_geometry(spark, sf_dir):
    """Corners decoded from the WKB of the communes, as text."""
    communes = read_layer(spark, FX.layer_files(spark, sf_dir), "communes", "partitioned")
    listed = lambda xs: F.concat(F.lit("["), F.array_join(xs, ", "), F.lit("]"))
    rings = F.transform(rings_of(F.col("geometry")), lambda r: listed(F.transform(r, lambda v: v.cast("string"))))
    return communes.select("id", listed(rings).alias("rings"))


EXTRACT_COMMUNE = "59000"
EXTRACT_DEPARTEMENTS = ("2A", "974")
EXTRACT_WINDOW = (1000.0, 1000.0, 3000.0, 2500.0, 2154)


@register("extract_commune", f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL AND commune = '{EXTRACT_COMMUNE}'")
def q_extract_commune(spark, sf_dir):
    return flat(extract.extract_commune(published(spark, sf_dir), EXTRACT_COMMUNE))


@register("extract_departement",
          f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL AND departement IN "
          f"({', '.join(repr(d) for d in EXTRACT_DEPARTEMENTS)})")
def q_extract_departement(spark, sf_dir):
    return flat(extract.extract_departement(published(spark, sf_dir), list(EXTRACT_DEPARTEMENTS)))


_x0, _y0, _x1, _y1, _srid = EXTRACT_WINDOW


@register("extract_extent",
          f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL AND bbox_xmax >= {_x0} AND bbox_xmin <= {_x1} "
          f"AND bbox_ymax >= {_y0} AND bbox_ymin <= {_y1} AND geom_srid = {_srid}")
def q_extract_extent(spark, sf_dir):
    return flat(extract.read_extent(spark, publish(spark, sf_dir), _x0, _y0, _x1, _y1, _srid))


def extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5x5 grid of overlapping windows, one per nation; some span the country."""
    n = F.col("n_nationkey")
    wide = F.pmod(n, F.lit(9)) == 4
    x0 = F.when(wide, F.lit(-1000000)).otherwise(F.pmod(n, F.lit(5)) * 2000)
    y0 = F.when(wide, F.lit(-1000000)).otherwise(F.floor(n / 5) * 2000)
    side = F.when(wide, F.lit(2000000)).otherwise(F.lit(2500))
    return A.table(spark, sf_dir, "nation").select(
        n.cast("bigint").alias("extent_id"), x0.cast("double").alias("xmin"), y0.cast("double").alias("ymin"),
        (x0 + side).cast("double").alias("xmax"), (y0 + side).cast("double").alias("ymax"),
        F.lit(S.SRID_DEFAULT).alias("srid"))


EXTENTS_SQL = ("SELECT extent_id, x0 AS xmin, y0 AS ymin, x0 + side AS xmax, y0 + side AS ymax, 2154 AS srid FROM ("
               "SELECT CAST(n_nationkey AS BIGINT) AS extent_id, CAST(CASE WHEN n_nationkey % 9 = 4 THEN -1000000 ELSE (n_nationkey % 5) * 2000 END AS DOUBLE) AS x0, "
               "CAST(CASE WHEN n_nationkey % 9 = 4 THEN -1000000 ELSE (n_nationkey // 5) * 2000 END AS DOUBLE) AS y0, "
               "CASE WHEN n_nationkey % 9 = 4 THEN 2000000 ELSE 2500 END AS side FROM nation)")


@register("extract_many_extents",
          f"SELECT e.extent_id, f.* FROM ({_ROUTED_SQL}) f JOIN ({EXTENTS_SQL}) e "
          f"ON f.bbox_xmax >= e.xmin AND f.bbox_xmin <= e.xmax AND f.bbox_ymax >= e.ymin AND f.bbox_ymin <= e.ymax "
          f"AND f.geom_srid = e.srid WHERE f.lot IS NOT NULL")
def q_extract_many_extents(spark, sf_dir):
    return flat(extract.read_many_extents(spark, publish(spark, sf_dir), extents(spark, sf_dir)))


@register("extents_of_layers",
          f"SELECT e.extent_id, f.* FROM ({UNIFIED_FLAT_SQL}) f JOIN ({EXTENTS_SQL}) e "
          f"ON f.bbox_xmax >= e.xmin AND f.bbox_xmin <= e.xmax AND f.bbox_ymax >= e.ymin AND f.bbox_ymin <= e.ymax "
          f"AND f.geom_srid = e.srid")
def q_extents_of_layers(spark, sf_dir):
    """The same join over features that are not exported yet, so without a zone table."""
    return flat(extract.extract_many_extents(unified(spark, sf_dir), extents(spark, sf_dir)))


# ------------------------------------------------------------ manifest ----


def after_host_sql(url: str) -> str:
    """What follows scheme and host, without query and fragment ('' at a bare host)."""
    rest = f"substr({url}, strpos({url}, '://') + 3)"
    tail = f"(CASE WHEN contains({rest}, '/') THEN substr({rest}, strpos({rest}, '/')) ELSE '' END)"
    return f"split_part(split_part({tail}, '#', 1), '?', 1)"


def host_sql(url: str) -> str:
    return f"split_part(split_part(split_part(split_part({url}, '://', 2), '/', 1), '?', 1), '#', 1)"


def basename_sql(url: str) -> str:
    return f"string_split({after_host_sql(url)}, '/')[-1]"


def normalize_sql(u: str) -> str:
    return (f"CASE WHEN NOT ends_with({u}, '/') AND NOT contains({basename_sql(u)}, '.') "
            f"THEN {u} || '/' ELSE {u} END")


MANIFEST_CLEAN_SQL = (f"SELECT page_id, trim(coalesce(format, '')) AS format, "
                      f"trim(coalesce(millesime, '')) AS millesime, trim(coalesce(source, '')) AS source "
                      f"FROM ({A.MANIFEST_SQL})")
MANIFEST_URL_SQL = (f"SELECT *, CASE WHEN length(source) > 0 THEN {normalize_sql('source')} END AS url "
                    f"FROM ({MANIFEST_CLEAN_SQL})")
FORMAT_FILTER = "shp"


def _outcome_sql(with_log: bool) -> str:
    skipped = "WHEN url IN (SELECT url FROM log_urls) THEN 'skipped' " if with_log else ""
    return (f"CASE WHEN length(source) = 0 THEN 'missing_url' WHEN format != '{FORMAT_FILTER}' THEN 'filtered' "
            f"{skipped}ELSE 'planned' END")


_LOG_CTE = f"WITH log_urls AS ({A.LOG_SQL}) "


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.file_listing(spark, sf_dir)


@register("manifest_plan", f"SELECT *, {_outcome_sql(False)} AS outcome FROM ({MANIFEST_URL_SQL})")
def q_manifest_plan(spark, sf_dir):
    return manifest.plan_manifest(A.manifest(spark, sf_dir), FORMAT_FILTER)


@register("manifest_file", f"SELECT page_id, format, millesime, source, url FROM ({MANIFEST_URL_SQL})")
def q_manifest_file(spark, sf_dir):
    """The manifest written as a tab-separated file and read back; blank vintages stay blank."""
    path = fresh_copy(spark, sf_dir, "manifest", lambda p: A.manifest(spark, sf_dir).write.csv(p, sep="\t", header=True))
    read = read_manifest(spark, path).withColumn("page_id", F.col("page_id").cast("bigint"))
    return manifest.plan_manifest(read).drop("outcome")


@register("manifest_resume",
          f"{_LOG_CTE}SELECT * FROM ({MANIFEST_URL_SQL}) m WHERE length(source) > 0 "
          f"AND format = '{FORMAT_FILTER}' AND NOT EXISTS (SELECT 1 FROM log_urls l WHERE l.url = m.url)")
def q_manifest_resume(spark, sf_dir):
    return manifest.resume_worklist(A.manifest(spark, sf_dir), A.download_log(spark, sf_dir), FORMAT_FILTER)


@register("manifest_outcomes",
          f"{_LOG_CTE}SELECT outcome, count(*) AS n FROM (SELECT {_outcome_sql(True)} AS outcome "
          f"FROM ({MANIFEST_URL_SQL})) GROUP BY outcome")
def q_manifest_outcomes(spark, sf_dir):
    plan = manifest.plan_manifest(A.manifest(spark, sf_dir), FORMAT_FILTER, A.download_log(spark, sf_dir))
    return manifest.outcome_counts(plan)


@register("manifest_formats",
          f"SELECT DISTINCT trim(format) AS format FROM ({A.MANIFEST_SQL}) WHERE length(trim(format)) > 0")
def q_manifest_formats(spark, sf_dir):
    return manifest.manifest_formats(A.manifest(spark, sf_dir))


@register("log_rebuild",
          f"SELECT 'https://' || split_part(rel, '/', 1) || '/' || substr(rel, strpos(rel, '/') + 1) AS url "
          f"FROM (SELECT substr(path, {len(A.MIRROR_ROOT) + 2}) AS rel, length FROM ({A.file_listing_sql()})) "
          f"WHERE length > 0 AND contains(rel, '/')")
def q_log_rebuild(spark, sf_dir):
    return manifest.rebuild_log(_listing(spark, sf_dir), A.MIRROR_ROOT)


# ----------------------------------------------------------- inventory ----

def _layer_of_sql(path: str) -> str:
    name = f"lower(regexp_extract({path}, '([^/\\\\]*)$', 1))"
    return "CASE " + " ".join(f"WHEN contains({name}, '{n}') THEN '{n}'" for n in S.LAYERS) + " END"


_LISTING_SQL = A.file_listing_sql()
_SHP_SQL = f"SELECT * FROM ({_LISTING_SQL}) WHERE ends_with(lower(path), '.shp')"


def _stem_sql(path: str) -> str:
    return f"regexp_replace({path}, '\\.[^./\\\\]*$', '')"


@register("file_inventory",
          f"SELECT ym, layer, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS total_bytes FROM ("
          f"SELECT strftime(\"modificationTime\", '%Y_%m') AS ym, {_layer_of_sql('path')} AS layer, length "
          f"FROM ({_SHP_SQL})) WHERE layer IS NOT NULL GROUP BY ym, layer")
def q_file_inventory(spark, sf_dir):
    return inventory.layer_inventory(_listing(spark, sf_dir))


@register("missing_sidecars",
          f"SELECT path FROM ({_SHP_SQL}) s WHERE NOT EXISTS (SELECT 1 FROM ({_LISTING_SQL}) c "
          f"WHERE ends_with(lower(c.path), '.cpg') AND {_stem_sql('c.path')} = {_stem_sql('s.path')})")
def q_missing_sidecars(spark, sf_dir):
    return inventory.missing_sidecars(_listing(spark, sf_dir))


@register("sidecar_counts",
          f"SELECT count(*) AS n_shapefiles, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ({_LISTING_SQL}) c "
          f"WHERE ends_with(lower(c.path), '.cpg') AND {_stem_sql('c.path')} = {_stem_sql('s.path')})) AS n_to_create "
          f"FROM ({_SHP_SQL}) s")
def q_sidecar_counts(spark, sf_dir):
    return inventory.sidecar_counts(_listing(spark, sf_dir))


@register("conversion_plan",
          f"SELECT path, CASE WHEN EXISTS (SELECT 1 FROM ({_LISTING_SQL}) p WHERE ends_with(lower(p.path), '.parquet') "
          f"AND {_stem_sql('p.path')} = {_stem_sql('s.path')}) THEN 'skipped' ELSE 'to_convert' END AS outcome "
          f"FROM ({_SHP_SQL}) s")
def q_conversion_plan(spark, sf_dir):
    return inventory.conversion_plan(_listing(spark, sf_dir))


# --------------------------------------------------------------- links ----

# the <a> tags, their 'name = value' pieces, the first one named href, unquoted and decoded
_TAG_RE = A.sql_text(r"""(?is)<a[ \n\t/](?:[^>"']|"[^"]*"|'[^']*')*>""")
_PIECE_RE = A.sql_text(r"""[^ \n\t=/<>"']+ *= *(?:"[^"]*"|'[^']*'|[^ \n\t>"']+)""")
_TAGS_SQL = (f"SELECT page_id, url, regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
             f"'(?is)<script[ >].*?</script *>', '', 'g'), {_TAG_RE}) AS tags FROM ({A.PAGES_SQL})")
_VALUES_SQL = (f"SELECT page_id, url, list_filter(list_transform(tags, lambda t: list_filter(regexp_extract_all(t, {_PIECE_RE}), "
               f"lambda p: lower(trim(split_part(p, '=', 1))) = 'href')[1]), lambda p: p IS NOT NULL) AS named FROM ({_TAGS_SQL})")


def _decoded_sql(v: str) -> str:
    for ref, char in (("&#38;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        v = f"replace({v}, {A.sql_text(ref)}, {A.sql_text(char)})"
    return v


_UNQUOTED = f"CASE WHEN v[1] IN ({A.sql_text(chr(34))}, {A.sql_text(chr(39))}) THEN substr(v, 2, length(v) - 2) ELSE v END"
_HREFS_SQL = (f"SELECT page_id, url, list_transform(list_transform(list_transform(named, lambda p: ltrim(substr(p, strpos(p, '=') + 1), ' ')), "
              f"lambda v: {_UNQUOTED}), lambda h: {_decoded_sql('h')}) AS hrefs FROM ({_VALUES_SQL})")


def _followable_sql(h: str) -> str:
    return (f"({h} <> '' AND NOT starts_with({h}, 'http') AND NOT starts_with({h}, '#') "
            f"AND NOT starts_with({h}, 'javascript:'))")


def _dots_sql(p: str, rounds: int = 4) -> str:
    out = f"regexp_replace({p}, '/\\./', '/', 'g')"
    for _ in range(rounds):
        out = f"regexp_replace({out}, '/[^/]+/\\.\\./', '/')"
    return out


def _resolve_sql(base: str, raw: str) -> str:
    h = f"ltrim({raw}, ' ')"
    origin = f"split_part({base}, '://', 1) || '://' || {host_sql(base)}"
    at = lambda c: f"CASE WHEN contains({h}, '{c}') THEN strpos({h}, '{c}') ELSE 1000000 END"
    end = f"least({at('?')}, {at('#')})"
    hpath, rest = f"substr({h}, 1, {end} - 1)", f"substr({h}, {end})"
    bpath = after_host_sql(base)
    folder = f"(CASE WHEN contains({bpath}, '/') THEN substr({bpath}, 1, length({bpath}) - length({basename_sql(base)})) ELSE '/' END)"
    return (f"CASE WHEN regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN split_part({base}, '://', 1) || ':' || {h} "
            f"WHEN starts_with({hpath}, '/') THEN {origin} || {_dots_sql(hpath)} || {rest} "
            f"ELSE {origin} || {_dots_sql(folder + ' || ' + hpath)} || {rest} END")


@register("page_links",
          f"SELECT page_id, url, pos, href, {_resolve_sql('url', 'href')} AS link FROM ("
          f"SELECT page_id, url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos FROM ({_HREFS_SQL})) "
          f"WHERE {_followable_sql('href')} AND href NOT IN ('../', './', '/')")
def q_page_links(spark, sf_dir):
    return links.page_links(A.pages_with_edges(spark, sf_dir))


@register("directory_pages",
          f"SELECT page_id, url FROM ({_HREFS_SQL}) WHERE ends_with(url, '/') AND "
          f"len(list_filter(hrefs, lambda h: {_followable_sql('h')} AND (ends_with(h, '/') OR contains(h, '.')))) > 0")
def q_directory_pages(spark, sf_dir):
    return links.directory_pages(A.pages_with_edges(spark, sf_dir))


_SITE_SQL = f"SELECT '{A.SITE}' || page_id || CASE WHEN page_id % 5 = 0 AND page_id > 0 THEN '' ELSE '/' END AS url, page_id AS n FROM pages"


@register("crawl_files",
          f"WITH RECURSIVE site AS ({_SITE_SQL}), own AS (SELECT n, h FROM (SELECT page_id AS n, unnest(hrefs) AS h FROM ({_HREFS_SQL})) "
          f"WHERE n >= 0 AND {_followable_sql('h')} AND h NOT IN ('../', './', '/')), "
          f"link AS (SELECT url, {_resolve_sql('url', 'h')} AS link FROM (SELECT url, unnest(['/' || (2 * n + 1) || '/', '/' || (2 * n + 2) || '/', "
          f"'/' || (n // 2) || '/', 'f' || n || '.zip']) AS h FROM site UNION ALL SELECT s.url, own.h FROM site s JOIN own USING (n)) WHERE ends_with(url, '/')), "
          f"r(url, depth) AS (SELECT '{A.SITE}0/', 0 UNION SELECT '{A.SITE}10', 0 UNION "
          f"SELECT l.link, r.depth + 1 FROM r JOIN link l ON l.url = r.url WHERE ends_with(l.link, '/') AND r.depth < 40), "
          f"seen AS (SELECT url, min(depth) AS depth FROM r GROUP BY url) "
          f"SELECT file, folder, min(depth) AS depth FROM (SELECT l.link AS file, s.url AS folder, s.depth + 1 AS depth FROM seen s JOIN link l ON l.url = s.url "
          f"WHERE NOT ends_with(l.link, '/') UNION ALL SELECT url, '{A.SITE}', depth FROM seen WHERE url = '{A.SITE}10') GROUP BY file, folder")
def q_crawl_files(spark, sf_dir):
    seeds = spark.createDataFrame([(f"{A.SITE}0/",), (f"{A.SITE}10",)], "url string")
    return links.crawl(A.site_pages(spark, sf_dir), seeds)


@register("reachable_files",
          f"WITH RECURSIVE edges AS ({A.LINK_EDGES_SQL}), r(node) AS (SELECT CAST(0 AS BIGINT) UNION "
          f"SELECT e.dst FROM r JOIN edges e ON e.src = r.node) SELECT node FROM r")
def q_reachable_files(spark, sf_dir):
    seeds = spark.range(1).select(F.col("id").alias("node"))
    return links.reachable(A.link_edges(spark, sf_dir), seeds).select("node")


# ------------------------------------------------------------- spatial ----


def _locate_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Subdivisions, with and without a parcel, and communes, read from the layer files."""
    root = FX.layer_files(spark, sf_dir)
    subdivisions = enrich.enrich_layer(read_layer(spark, root, "subdivisions_fiscales", "partitioned"), "subdivisions_fiscales")
    communes = enrich.enrich_layer(read_layer(spark, root, "communes", "partitioned"), "communes")
    return subdivisions, communes


# crossings of a ray with the rings' sides; the point's square gives the commune's number
_RINGS_SQL = (f"SELECT {A.commune_sql('k')} AS commune, k, unnest({A.commune_rings_sql('k')}) AS ring "
              f"FROM (SELECT DISTINCT {A.ck_sql('c_custkey')} AS k FROM customer)")
_SIDES_SQL = (f"SELECT commune, k, ring[2 * i + 1] AS ax, ring[2 * i + 2] AS ay, ring[2 * i + 3] AS bx, ring[2 * i + 4] AS b_y "
              f"FROM (SELECT commune, k, ring, unnest(range(len(ring) // 2 - 1)) AS i FROM ({_RINGS_SQL}))")
_LOCATED_SQL = (
    f"WITH u AS (SELECT id, lettre, parcelle, geometry_bbox.xmin + 0.5 AS px, geometry_bbox.ymin + 0.5 AS py FROM ({A.layer_sql('subdivisions_fiscales')})), "
    f"p AS (SELECT DISTINCT px, py FROM u WHERE parcelle IS NULL), sides AS ({_SIDES_SQL}), "
    f"m AS (SELECT px, py, min(commune) AS commune FROM (SELECT px, py, commune FROM p JOIN sides ON k = CAST(floor(px / 100) + 100 * floor(py / 100) AS BIGINT) "
    f"WHERE (ay > py) <> (b_y > py) AND px < ax + (py - ay) / (b_y - ay) * (bx - ax) GROUP BY px, py, commune HAVING count(*) % 2 = 1) GROUP BY px, py) "
    f"SELECT u.id, u.lettre, u.parcelle, CASE WHEN parcelle IS NOT NULL THEN left(parcelle, 5) ELSE coalesce(m.commune, '00000') END AS commune, "
    f"CASE WHEN parcelle IS NOT NULL THEN {dep_of_sql('parcelle')} ELSE coalesce({dep_of_sql('m.commune')}, '000') END AS departement "
    f"FROM u LEFT JOIN m USING (px, py)")


@register("locate_by_containment", f"SELECT id, lettre, commune, departement FROM ({_LOCATED_SQL}) WHERE parcelle IS NULL")
def q_locate_by_containment(spark, sf_dir):
    subdivisions, communes = _locate_inputs(spark, sf_dir)
    out = spatial.locate_by_containment(subdivisions.where(F.col("parcelle").isNull()), communes, match_srid=False)
    return out.select("id", "lettre", "commune", "departement")


@register("locate_mixed", _LOCATED_SQL)
def q_locate_mixed(spark, sf_dir):
    """All subdivisions: those with a parcel keep their commune, whatever polygon they lie in."""
    subdivisions, communes = _locate_inputs(spark, sf_dir)
    out = spatial.locate_by_containment(subdivisions, communes, match_srid=False)
    return out.select("id", "lettre", "parcelle", "commune", "departement")


# -------------------------------------------------------------- stream ----


@register("incremental_layers", UNIFIED_FLAT_SQL)
def q_incremental_layers(spark, sf_dir):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "landed")
    ckpt = scratch_path(spark, "landing-checkpoint")
    half = len(S.LAYERS) // 2
    FX.land_layer_files(spark, sf_dir, landing, S.LAYERS[:half])
    incremental.land_layers(spark, landing, out, ckpt)
    FX.land_layer_files(spark, sf_dir, landing, S.LAYERS[half:])
    incremental.land_layers(spark, landing, out, ckpt)
    return flat(spark.read.schema(PUBLISHED).parquet(out).drop("lot"))


@register("incremental_published", f"SELECT * FROM ({_ROUTED_SQL}) WHERE lot IS NOT NULL")
def q_incremental_published(spark, sf_dir):
    """The sorted export kept up to date: half of the layers first; then the rest, and some files again under other names."""
    landing, store, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "store"), scratch_path(spark, "landing-checkpoint")
    half = len(S.LAYERS) // 2
    FX.land_layer_files(spark, sf_dir, landing, S.LAYERS[:half])
    incremental.land_published(spark, landing, store, ckpt)
    FX.land_layer_files(spark, sf_dir, landing, S.LAYERS[half - 1:])
    out = incremental.land_published(spark, landing, store, ckpt)
    discard(spark, landing)
    return flat(read_published(spark, out))


# ------------------------------------------------------ links resume ----

MIRROR = "/mirror"


def _local_path_sql(url: str, link: str) -> str:
    parts = f"string_split({after_host_sql(url)}, '/')"
    dirs = f"(CASE WHEN contains({parts}[-1], '.') THEN {parts}[1:len({parts}) - 1] ELSE {parts} END)"
    dirs = f"list_filter({dirs}, lambda d: d <> '')"
    return f"'{MIRROR}/' || {host_sql(url)} || '/' || array_to_string(list_append({dirs}, {basename_sql(link)}), '/')"


def downloaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirror listing of the page links, its paths built from the URLs' parts
    (not by the operator): links at even positions were fetched; those at
    positions divisible by 4 are empty files."""
    pl = links.page_links(A.pages_with_edges(spark, sf_dir)).where(F.pmod("pos", F.lit(2)) == 0)
    bare = lambda u: F.split(F.regexp_replace(F.regexp_replace(u, "^[^:]*://", ""), "[?#].*$", ""), "/")
    path, name = bare(F.col("url")), F.element_at(bare(F.col("link")), -1)
    named = (F.size(path) > 1) & F.element_at(path, -1).contains(".")
    kept = F.when(named, F.slice(path, 1, F.size(path) - 1)).otherwise(path)
    full = F.concat(F.array(F.lit(MIRROR)), F.filter(kept, lambda d: d != ""), F.array(name))
    return pl.select(F.array_join(full, "/").alias("path"), F.pmod("pos", F.lit(4)).cast("bigint").alias("length"))


_PAGE_LINKS_SQL = _ORACLE["page_links"]


@register("links_resume",
          f"WITH pl AS ({_PAGE_LINKS_SQL}), files AS (SELECT {_local_path_sql('url', 'link')} AS path, "
          f"CAST(pos % 4 AS BIGINT) AS length FROM pl WHERE pos % 2 = 0) "
          f"SELECT * FROM pl WHERE NOT ends_with(link, '/') AND {_local_path_sql('url', 'link')} NOT IN "
          f"(SELECT path FROM files WHERE length > 0)")
def q_links_resume(spark, sf_dir):
    pl = links.page_links(A.pages_with_edges(spark, sf_dir))
    _, todo = links.split_by_presence(pl, downloaded_files(spark, sf_dir), MIRROR)
    return todo


@register("links_done",
          f"WITH pl AS ({_PAGE_LINKS_SQL}), files AS (SELECT {_local_path_sql('url', 'link')} AS path, "
          f"CAST(pos % 4 AS BIGINT) AS length FROM pl WHERE pos % 2 = 0) "
          f"SELECT DISTINCT url FROM ({A.LOG_SQL} UNION ALL SELECT link FROM pl WHERE NOT ends_with(link, '/') "
          f"AND {_local_path_sql('url', 'link')} IN (SELECT path FROM files WHERE length > 0))")
def q_links_done(spark, sf_dir):
    """The log with the links whose files are there, written and read back."""
    pl = links.page_links(A.pages_with_edges(spark, sf_dir))
    done, _ = links.split_by_presence(pl, downloaded_files(spark, sf_dir), MIRROR)
    log = manifest.append_log(A.download_log(spark, sf_dir), done.select(F.col("link").alias("url")))
    return read_log(spark, fresh_copy(spark, sf_dir, "log", lambda p: write_log(log, p)), layout="lines")


@register("log_versions", _ORACLE["links_done"])
def q_log_versions(spark, sf_dir):
    """The same log kept as segments: three appends, the last of them of nothing new, and a compaction."""
    pl = links.page_links(A.pages_with_edges(spark, sf_dir))
    done, _ = links.split_by_presence(pl, downloaded_files(spark, sf_dir), MIRROR)
    done = done.select(F.col("link").alias("url"))

    def fill(path: str) -> None:
        store = LogStore(spark, path)
        for part in (A.download_log(spark, sf_dir), done, done):
            store.append(part)
        store.compact()

    return LogStore(spark, fresh_copy(spark, sf_dir, "log-store", fill)).read()


# ------------------------------------------------------ seed outcomes ----

def fetch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-link fetch results derived from the page links: directory links
    answer with a listing; every 5th file link failed."""
    pl = links.page_links(A.pages_with_edges(spark, sf_dir))
    outcome = (F.when(F.col("link").endswith("/"), F.lit(manifest.FETCH_DIRECTORY))
               .when(F.pmod("pos", F.lit(5)) == 0, F.lit(manifest.FETCH_FAILURE))
               .otherwise(F.lit(manifest.FETCH_SUCCESS)))
    return pl.select(F.col("url").alias("seed"), "link", outcome.alias("outcome"))


@register("seed_outcomes",
          f"SELECT seed, count(*) FILTER (WHERE outcome = 'success') AS n_success, "
          f"count(*) FILTER (WHERE outcome = 'failure') AS n_failure, "
          f"count(*) FILTER (WHERE outcome = 'directory') AS n_directory, "
          f"count(*) FILTER (WHERE outcome = 'failure') = 0 AS done FROM ("
          f"SELECT url AS seed, CASE WHEN ends_with(link, '/') THEN 'directory' WHEN pos % 5 = 0 THEN 'failure' "
          f"ELSE 'success' END AS outcome FROM ({_PAGE_LINKS_SQL})) GROUP BY seed")
def q_seed_outcomes(spark, sf_dir):
    return manifest.seed_outcomes(fetch_results(spark, sf_dir))


# ------------------------------------------------- files, logs, outcomes ----

@register("resume_logs",
          f"SELECT 'valid' AS state, url FROM ({A.LOG_SQL}) UNION ALL SELECT state, url FROM (SELECT DISTINCT url FROM ({_ORACLE['log_rebuild']})), "
          f"(SELECT unnest(['absent', 'corrupt']) AS state)")
def q_resume_logs(spark, sf_dir):
    """The log to resume from when it is valid (a folder of documents), absent, or corrupt."""
    urls = A.download_log(spark, sf_dir).groupBy(F.pmod(F.xxhash64("url"), F.lit(64)).alias("k")).agg(F.collect_list("url").alias(S.LOG_KEY))
    valid = fresh_copy(spark, sf_dir, "log-valid", lambda p: urls.select(S.LOG_KEY).write.option("maxRecordsPerFile", 1).json(p))
    broken = spark.range(1).select(F.lit('{"downloaded_urls": ["https://').alias("value"))
    corrupt = fresh_copy(spark, sf_dir, "log-corrupt", lambda p: broken.write.text(p))
    listing = _listing(spark, sf_dir)
    cases = (("valid", valid), ("absent", f"{valid}-none"), ("corrupt", corrupt))
    out = [manifest.resume_log(spark, p, listing, A.MIRROR_ROOT).select(F.lit(c).alias("state"), "url") for c, p in cases]
    return reduce(DataFrame.unionByName, out)


def _tried(plan: DataFrame) -> DataFrame:
    """Results of a conversion run over the files to convert: by the last digit of the name, 7 failed and 3 was not tried."""
    last = F.regexp_extract("path", r"(\d)\.[^.]*$", 1)
    tried = plan.where((F.col("outcome") == inventory.TO_CONVERT) & (last != "3"))
    return tried.select("path", (last != "7").alias("ok"), F.when(last == "7", F.concat(F.lit("cannot read "), "path")).alias("message"))


_TRIED_SQL = (f"SELECT path, CASE WHEN outcome = 'skipped' THEN 'skipped' WHEN d = '3' THEN 'to_convert' WHEN d = '7' THEN 'failed' ELSE 'success' END AS outcome "
              f"FROM (SELECT path, outcome, string_split(path, '.')[-2][-1] AS d FROM ({_ORACLE['conversion_plan']}))")


@register("conversion_outcomes", f"SELECT outcome, count(*) AS n FROM ({_TRIED_SQL}) GROUP BY outcome")
def q_conversion_outcomes(spark, sf_dir):
    plan = inventory.conversion_plan(_listing(spark, sf_dir))
    return inventory.conversion_counts(inventory.conversion_results(plan, _tried(plan)))


@register("conversion_failures", f"SELECT path, 'cannot read ' || path AS message FROM ({_TRIED_SQL}) WHERE outcome = 'failed'")
def q_conversion_failures(spark, sf_dir):
    plan = inventory.conversion_plan(_listing(spark, sf_dir))
    return inventory.conversion_failures(inventory.conversion_results(plan, _tried(plan)))


def _attempts(plan: DataFrame) -> DataFrame:
    """The same run with what came before it: every tried file failed once, and files that end in 2 a second time after their success."""
    run = _tried(plan).withColumn("at", F.lit(2))
    first = run.select("path", F.lit(False).alias("ok"), F.lit("out of memory").alias("message"), F.lit(1).alias("at"))
    last = run.where(F.regexp_extract("path", r"(\d)\.[^.]*$", 1) == "2").select("path", F.lit(False).alias("ok"), F.lit("disk full").alias("message"), F.lit(3).alias("at"))
    return run.unionByName(first).unionByName(last)


@register("conversion_retries",
          f"SELECT path, CASE WHEN outcome = 'success' AND d = '2' THEN 'failed' ELSE outcome END AS outcome, "
          f"CASE WHEN outcome = 'failed' THEN 'cannot read ' || path WHEN outcome = 'success' AND d = '2' THEN 'disk full' END AS message "
          f"FROM (SELECT path, outcome, string_split(path, '.')[-2][-1] AS d FROM ({_TRIED_SQL}))")
def q_conversion_retries(spark, sf_dir):
    """One outcome a file, the latest, where files were tried two and three times."""
    plan = inventory.conversion_plan(_listing(spark, sf_dir))
    return inventory.conversion_results(plan, _attempts(plan))


@register("file_lists",
          f"SELECT strftime(\"modificationTime\", '%Y_%m') AS ym, {_layer_of_sql('path')} AS layer, path FROM ({_SHP_SQL}) WHERE {_layer_of_sql('path')} IS NOT NULL")
def q_file_lists(spark, sf_dir):
    """The text lists written and read back."""
    path = fresh_copy(spark, sf_dir, "lists", lambda p: inventory.write_lists(_listing(spark, sf_dir), p))
    return spark.read.schema("value string, ym string, layer string").text(path).select("ym", "layer", F.col("value").alias("path"))


@register("list_files", f"SELECT DISTINCT 'communes' AS layer, {dep_of_sql('id')} AS departement FROM ({A.layer_sql('communes')})")
def q_list_files(spark, sf_dir):
    """A real tree: communes written by département, listed by an extension in another case."""
    layer = A.layer(spark, sf_dir, "communes").withColumn("layer", F.lit("communes")).withColumn("departement", departement_of("id"))
    layer = layer.select("layer", "departement", "id").hint("rebalance", "departement")
    path = fresh_copy(spark, sf_dir, "tree", lambda p: layer.write.partitionBy("layer", "departement").parquet(p))
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    return list_files(spark, path, ".PARQUET").select(part("layer").alias("layer"), part("departement").alias("departement")).distinct()


@register("mirror_listing", f"SELECT path, length, TRUE AS dated FROM ({A.MIRROR_FILES_SQL})")
def q_mirror_listing(spark, sf_dir):
    """Every file of a real tree with its length, and whether its time is of today: empty and hidden ones too."""
    root = FX.mirror_tree(spark, sf_dir)
    dated = F.col("modificationTime").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp() + F.expr("INTERVAL 1 DAY"))
    return list_files(spark, root).select(F.col("path").substr(F.length(F.lit(root)) + 2, F.length("path")).alias("path"), "length", dated.alias("dated"))


@register("stored_pages", "SELECT url, count(*) AS n FROM pages GROUP BY url")
def q_stored_pages(spark, sf_dir):
    return read_pages(spark, f"{sf_dir}/pages.parquet").groupBy("url").agg(F.count("*").alias("n"))
