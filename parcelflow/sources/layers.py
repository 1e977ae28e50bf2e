"""Readers for layer files, export batches and the published dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schema as S


def read_layer(spark: SparkSession, root: str, layer: str, layout: str = "glob") -> DataFrame:
    """All Parquet data of one layer below ``root``.

    ``glob``: every file named ``<layer>.parquet`` at any depth (one file per
    département, as a converter writes them).  ``partitioned``: a dataset
    written with ``partitionBy('layer')`` (what :func:`write_layers` makes),
    read with partition pruning.  ``dataset``: ``root/<layer>.parquet`` as a
    folder of files (what :func:`write_layer_file` makes).  The declared schema
    makes a column absent from some file read as NULL.
    """
    sch = S.layer_schema(layer)
    if layout == "glob":
        return (spark.read.schema(sch).option("recursiveFileLookup", "true")
                .option("pathGlobFilter", f"{layer}.parquet").parquet(root))
    if layout == "partitioned":
        full = T.StructType(sch.fields + [T.StructField("layer", T.StringType())])
        return (spark.read.schema(full).option("basePath", root).parquet(root)
                .where(f"layer = '{layer}'").drop("layer"))
    if layout == "dataset":
        return spark.read.schema(sch).parquet(f"{root}/{layer}.parquet")
    raise ValueError("layout must be 'glob', 'partitioned' or 'dataset'")


def read_layers(spark: SparkSession, root: str, layout: str = "glob") -> dict[str, DataFrame]:
    return {name: read_layer(spark, root, name, layout) for name in S.LAYERS}


PUBLISHED = T.StructType(list(S.CANONICAL.fields) + [T.StructField("lot", T.StringType())])


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The exported dataset (all batches); ``lot`` is its partition column."""
    return spark.read.schema(PUBLISHED).option("basePath", path).parquet(path)


def read_batches(spark: SparkSession, path: str, lots: list[str] | None = None) -> DataFrame:
    """Only some batches, by directory (partition pruning without a filter)."""
    if not lots:
        return read_published(spark, path)
    return (spark.read.schema(PUBLISHED).option("basePath", path)
            .parquet(*[f"{path}/lot={lot}" for lot in lots]))


def read_files(spark: SparkSession, path: str, files: list) -> DataFrame:
    """Some files, as (lot, file name), of the exported dataset ``path``; no other is listed or opened."""
    if not files:
        return read_published(spark, path).where("false")
    return spark.read.schema(PUBLISHED).option("basePath", path).parquet(*sorted(f"{path}/lot={lot}/{file}" for lot, file in files))
