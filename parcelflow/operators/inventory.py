"""File inventories: layer lists by month, missing sidecars, conversion plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

TO_CONVERT = "to_convert"
SKIPPED = "skipped"
OVERWRITE = "overwrite"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path) -> Column:
    """Last path component ('/' or '\\' separated), without regex backtracking."""
    return F.substring_index(F.substring_index(_c(path), "/", -1), "\\", -1)


def extension_is(path, ext: str) -> Column:
    """Case-insensitive extension test (``.shp`` matches ``.SHP``)."""
    return F.lower(_c(path)).endswith(ext.lower())


def stem(path) -> Column:
    """Path without the last extension of its file name."""
    p, name = _c(path), file_name(path)
    ext_len = F.length(F.substring_index(name, ".", -1)) + 1
    return F.when(name.contains("."), p.substr(F.lit(1), F.length(p) - ext_len)).otherwise(p)


def layer_of(path) -> Column:
    """First layer name contained in the lower-cased file name (list order)."""
    name = F.lower(file_name(path))
    expr = None
    for layer in S.LAYERS:
        cond = name.contains(layer)
        expr = F.when(cond, F.lit(layer)) if expr is None else expr.when(cond, F.lit(layer))
    return expr


def month_key(ts) -> Column:
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy_MM")


def has_layer(path) -> Column:
    """True when some layer name occurs in the file name (= layer_of not NULL)."""
    return F.lower(file_name(path)).rlike("|".join(S.LAYERS))


def classify_shapefiles(files: DataFrame) -> DataFrame:
    """``.shp`` files with their (month, layer); unclassified ones dropped."""
    return (files.where(extension_is("path", ".shp") & has_layer("path"))
            .select("path", "length", month_key("modificationTime").alias("ym"), layer_of("path").alias("layer")))


def layer_inventory(files: DataFrame) -> DataFrame:
    """Count and bytes of shapefiles per (month, layer)."""
    return classify_shapefiles(files).groupBy("ym", "layer").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("total_bytes"))


def write_lists(files: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Text lists of paths per (month, layer), as partition directories.

    Rows are rebalanced on the two keys: AQE joins small lists in a task and
    splits a long one over several files.
    """
    (classify_shapefiles(files).select("ym", "layer", "path")
        .hint("rebalance", "ym", "layer").write.mode(mode).partitionBy("ym", "layer").text(path))
    return path


def missing_sidecars(files: DataFrame, sidecar_ext: str = ".cpg") -> DataFrame:
    """``.shp`` files without a charset sidecar of the same stem."""
    shp = files.where(extension_is("path", ".shp")).select("path", stem("path").alias("_stem"))
    cpg = files.where(extension_is("path", sidecar_ext)).select(stem("path").alias("_stem")).distinct()
    return shp.join(cpg, "_stem", "left_anti").select("path")


def sidecar_counts(files: DataFrame, sidecar_ext: str = ".cpg") -> DataFrame:
    shp = files.where(extension_is("path", ".shp")).select(stem("path").alias("_stem"))
    cpg = files.where(extension_is("path", sidecar_ext)).select(stem("path").alias("_stem"), F.lit(True).alias("_has"))
    joined = shp.join(cpg.distinct(), "_stem", "left")
    return joined.agg(F.count("*").alias("n_shapefiles"),
                      F.count_if(F.col("_has").isNull()).alias("n_to_create"))


def conversion_plan(files: DataFrame, overwrite: bool = False) -> DataFrame:
    """Each shapefile and whether it must be converted.

    Without ``overwrite``, a shapefile whose Parquet twin exists is skipped.
    """
    shp = files.where(extension_is("path", ".shp")).select("path", stem("path").alias("_stem"))
    out = files.where(extension_is("path", ".parquet")).select(stem("path").alias("_stem"),
                                                               F.lit(True).alias("_done")).distinct()
    j = shp.join(out, "_stem", "left")
    if overwrite:
        outcome = F.when(F.col("_done").isNotNull(), F.lit(OVERWRITE)).otherwise(F.lit(TO_CONVERT))
    else:
        outcome = F.when(F.col("_done").isNotNull(), F.lit(SKIPPED)).otherwise(F.lit(TO_CONVERT))
    return j.select("path", outcome.alias("outcome"))


# --- fixed values: outcomes of a conversion ---------------------------------
SUCCESS = "success"
FAILED = "failed"
# ---------------------------------------------------------------------------


def conversion_results(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Every planned file once, with its outcome and, if it failed, its message.

    ``results`` has (path, ok, message) of the files tried and may have ``at``,
    the time of the attempt; a file that was to be converted and has no result
    yet stays ``to_convert``.  Of several results of a file (failed, then
    retried) the latest counts; without times, or at the same time, a success
    counts before a failure, and of failures the last message in text order.
    """
    at = F.col("at") if "at" in results.columns else F.lit(0)
    latest = F.max(F.struct(at.alias("at"), F.coalesce("ok", F.lit(False)).alias("ok"), "message"))
    tried = results.groupBy("path").agg(latest.alias("_r")).select("path", F.col("_r.ok").alias("_ok"), F.col("_r.message").alias("_message"))
    j = plan.dropDuplicates(["path"]).join(tried, "path", "left")
    outcome = F.when(F.col("outcome") == SKIPPED, F.lit(SKIPPED)).when(F.col("_ok"), F.lit(SUCCESS)).when(~F.col("_ok"), F.lit(FAILED)).otherwise(F.col("outcome"))
    return j.select("path", outcome.alias("outcome"), F.when(outcome == FAILED, F.col("_message")).alias("message"))


def conversion_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("outcome").agg(F.count("*").alias("n"))


def conversion_failures(results: DataFrame) -> DataFrame:
    """Each failed file with its message."""
    return results.where(F.col("outcome") == FAILED).select("path", "message")
