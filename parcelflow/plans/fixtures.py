"""File fixtures derived from the driver tables by Spark jobs.

Written once per (application, table directory) and reused, like any
materialised upstream dataset: the layer files, the listing of a mirror tree,
and a landing area of layer Parquet files for the streaming job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.codes import departement_of
from ..session import app_id, arrow_file_system, scratch_path
from . import adapters as A


def _at_once(spark: SparkSession, write: Callable[[str], None], layers: Iterable[str]) -> None:
    """``write`` for each layer, as jobs that run beside each other: the last tasks of one leave cores to the next."""
    names = list(layers)
    if names:
        with ThreadPoolExecutor(len(names)) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(write), n) for n in names]:
                done.result()


def land_layer_files(spark: SparkSession, sf_dir: str, landing: str, layers: tuple[str, ...]) -> None:
    """Drop raw layer files into ``landing/layer=<name>/`` (append)."""
    _at_once(spark, lambda name: A.layer(spark, sf_dir, name).write.mode("append").parquet(f"{landing}/layer={name}"), layers)


_LAYER_FILES: dict[tuple[str, str], str] = {}
LAYER_ROW_GROUP_BYTES = 4 * 1024 * 1024


def layer_files(spark: SparkSession, sf_dir: str) -> str:
    """All eight adapted layers, with WKB geometry, as zstd Parquet in one
    directory per layer (``layer=<name>``): the converted layer files the import
    step reads.  Each layer is written to its own directory, so a task streams
    its rows; a write partitioned by ``layer`` would sort, and spill, them first.
    Written once per session and folder."""
    key = (app_id(spark), sf_dir)
    if key not in _LAYER_FILES:
        root = scratch_path(spark, "layer-files")

        def write(name: str) -> None:
            # row groups of a few MB: like per-département layer files, every layer
            # splits into several input partitions instead of one big row group
            (A.layer(spark, sf_dir, name, with_geometry=True).write.option("compression", "zstd")
                .option("parquet.block.size", LAYER_ROW_GROUP_BYTES).parquet(f"{root}/layer={name}"))

        _at_once(spark, write, S.LAYERS)
        _LAYER_FILES[key] = root
    return _LAYER_FILES[key]


def glob_tree(spark: SparkSession, sf_dir: str, name: str, root: str) -> None:
    """A layer as a converter leaves it: one file ``<name>.parquet`` a département, some folders deep."""
    def write(key, rows):
        import pyarrow as pa
        import pyarrow.parquet as pq

        folder = key[0].as_py()
        system, where = arrow_file_system(f"{root}/{folder[:1]}/{folder}/{name}.parquet")
        system.create_dir(where.rpartition("/")[0], recursive=True)
        with system.open_output_stream(where, compression=None) as f:
            pq.write_table(rows.drop_columns(["departement"]), f)
        return pa.table({"n": pa.array([rows.num_rows], pa.int64())})

    layer = A.layer(spark, sf_dir, name).withColumn("departement", departement_of("commune"))
    layer.groupBy("departement").applyInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()


_MIRRORS: dict[tuple[str, str], str] = {}


def _write_files(batches):
    import pandas as pd

    for b in batches:
        for path, length in zip(b["path"], b["length"], strict=True):
            system, where = arrow_file_system(path)
            system.create_dir(where.rpartition("/")[0], recursive=True)
            with system.open_output_stream(where, compression=None) as f:
                f.write(b"x" * int(length))
        yield pd.DataFrame({"n": [len(b)]})


def mirror_tree(spark: SparkSession, sf_dir: str) -> str:
    """A tree of small files, written by tasks below the shared folder."""
    key = (app_id(spark), sf_dir)
    if key not in _MIRRORS:
        root = scratch_path(spark, "mirror")
        A.mirror_files(spark, sf_dir).select(F.concat(F.lit(root + "/"), "path").alias("path"), "length").mapInPandas(_write_files, "n bigint").write.format("noop").mode("overwrite").save()
        _MIRRORS[key] = root
    return _MIRRORS[key]


_LISTINGS: dict[tuple[str, str], str] = {}


def file_listing(spark: SparkSession, sf_dir: str):
    """The mirror-tree listing (path, modificationTime, length) as a table,
    shaped like the ``binaryFile`` source's metadata columns."""
    key = (app_id(spark), sf_dir)
    if key not in _LISTINGS:
        path = scratch_path(spark, "listing")
        A.file_listing(spark, sf_dir).write.option("compression", "zstd").parquet(path)
        _LISTINGS[key] = path
    return spark.read.parquet(_LISTINGS[key])
