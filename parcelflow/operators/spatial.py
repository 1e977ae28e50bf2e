"""Location of unlocated features by containment in commune polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.geometry import point_on_surface, rings_of
from ..functions.grid import cell, level_of, levels_used, with_cells
from ..session import materialised


def is_unlocated(commune: str = "commune") -> Column:
    return F.col(commune) == F.lit(S.UNLOCATED_COMMUNE)


def sides_of(rings: Column) -> Column:
    """The sides of all rings that a horizontal ray can cross: structs ax, ay, bx, by (closed rings, none horizontal)."""
    def of_ring(r: Column) -> Column:
        at = lambda i, k: F.get(r, i * 2 + k)
        side = lambda i: F.struct(at(i, 0).alias("ax"), at(i, 1).alias("ay"), at(i, 2).alias("bx"), at(i, 3).alias("by"))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(r) / 2).cast("int") - 2, F.lit(0))), side)

    sides = F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 8), of_ring))
    return F.filter(sides, lambda s: s["ay"] != s["by"])


def prepared(communes: DataFrame, match_srid: bool = True) -> DataFrame:
    """Communes once a shape, with their sides and the bands these are cut into.

    A shape's height is divided into bands of ``_high``, half the mean height of
    its sides, so that the sides, each counted in every band it touches, make at
    most four rows a side.  Only the sides of a point's own band can be crossed by
    the ray from it.
    """
    c = communes.where(F.col("geometry").isNotNull())
    b = lambda f: F.col(f"geometry_bbox.{f}").cast("double")
    srid = [F.col("geom_srid").alias("_srid")] if match_srid else []
    shape = F.xxhash64("commune", "geometry", *(["geom_srid"] if match_srid else []))
    c = c.select(shape.alias("_shape"), *srid, F.col("commune").alias("_commune"), F.col("departement").alias("_departement"),
                 *(b(k).alias(f"_{k}") for k in ("xmin", "ymin", "xmax", "ymax")), "geometry").dropDuplicates(["_shape"])
    c = c.withColumn("_sides", sides_of(rings_of(F.col("geometry")))).drop("geometry")
    travel = F.aggregate("_sides", F.lit(0.0), lambda acc, s: acc + F.abs(s["by"] - s["ay"]))
    return c.where(F.size("_sides") > 0).withColumn("_high", travel / (F.size("_sides") * 2))


def _band(y: Column) -> Column:
    return F.floor((y - F.col("_ymin")) / F.col("_high"))


def locate_points(points: DataFrame, communes: DataFrame, base: float = 100.0, match_srid: bool = True) -> DataFrame:
    """For points (``_g, _px, _py[, _srid]``): the commune that contains each.

    Points meet communes in grid cells sized by the commune's box (at most four
    a commune, one a level for a point).  Those inside the box meet the sides in
    their own band of the commune, one row a side, and an odd number of
    crossings to the right means inside (even-odd: holes and parts included).
    A point so meets a few sides, however many the commune has, and no ring is
    shuffled or walked for it.  A point inside several communes (shared borders)
    takes the smallest code.
    """
    keys = ["_srid"] if match_srid else []
    shapes = materialised(prepared(communes, match_srid), "shapes")
    boxes = shapes.drop("_sides", "_commune", "_departement")
    box = tuple(F.col(f"_{k}") for k in ("xmin", "ymin", "xmax", "ymax"))
    level = level_of(*box, base)
    cells = with_cells(boxes, F.array(level), box, base)
    levels = levels_used(boxes, level)
    p = points.withColumn("_l", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    p = p.withColumn("_cx", cell(F.col("_px"), F.col("_l"), base)).withColumn("_cy", cell(F.col("_py"), F.col("_l"), base))
    near = p.join(cells, ["_l", "_cx", "_cy", *keys])
    near = near.where((F.col("_px") >= F.col("_xmin")) & (F.col("_px") <= F.col("_xmax")) & (F.col("_py") >= F.col("_ymin")) & (F.col("_py") <= F.col("_ymax")))
    near = near.select("_g", *keys, "_px", "_py", "_shape", _band(F.col("_py")).alias("_b"))
    sides = shapes.select("_shape", "_ymin", "_high", F.explode("_sides").alias("s")).select("_shape", "_ymin", "_high", "s.*")
    sides = sides.select("_shape", "ax", "ay", "bx", "by", F.explode(F.sequence(_band(F.least("ay", "by")), _band(F.greatest("ay", "by")))).alias("_b"))
    crossed = ((F.col("ay") > F.col("_py")) != (F.col("by") > F.col("_py"))) & (F.col("_px") < (F.col("bx") - F.col("ax")) * (F.col("_py") - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax"))
    hit = near.join(sides, ["_shape", "_b"]).where(crossed)
    inside = hit.groupBy("_g", *keys, "_shape").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("_g", *keys, "_shape")
    named = inside.join(shapes.select("_shape", "_commune", "_departement"), "_shape")
    return named.groupBy("_g", *keys).agg(F.min(F.struct("_commune", "_departement")).alias("_m")).select("_g", *keys, "_m._commune", "_m._departement")


def locate_by_containment(features: DataFrame, communes: DataFrame, base: float = 100.0, match_srid: bool = True) -> DataFrame:
    """Rows with the placeholder commune get the commune containing an interior
    point of their geometry; unmatched ones keep the placeholder.  Rows that
    have a commune pass through unchanged.

    The work is keyed by the geometry, not the row: a distinct geometry's point
    is computed and located once, only (digest, point) is kept, and the answer
    is joined back on the digest, where AQE can split a frequent geometry.
    """
    digest = F.sha1("geometry")
    open_ = features.where(is_unlocated())
    keys = ["_srid"] if match_srid else []
    srid = [F.col("geom_srid").alias("_srid")] if match_srid else []
    shapes = open_.where(F.col("geometry").isNotNull()).select(digest.alias("_g"), *srid, "geometry").dropDuplicates(["_g", *keys])
    points = shapes.withColumn("_pt", point_on_surface(F.col("geometry"))).select("_g", *keys, F.col("_pt.x").alias("_px"), F.col("_pt.y").alias("_py"))
    located = locate_points(materialised(points, "points"), communes, base, match_srid)
    joined = open_.withColumn("_g", digest)
    if match_srid:
        joined = joined.withColumn("_srid", F.col("geom_srid"))
    out = joined.join(located, ["_g", *keys], "left")
    out = out.withColumn("commune", F.coalesce("_commune", "commune")).withColumn("departement", F.coalesce("_departement", "departement"))
    return features.where(~F.coalesce(is_unlocated(), F.lit(False))).unionByName(out.select(*features.columns))
