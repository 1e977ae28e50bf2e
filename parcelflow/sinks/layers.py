"""Layer and list sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_layers(df: DataFrame, path: str, mode: str = "append", compression: str = "zstd") -> str:
    """Layer rows (with a ``layer`` column) as zstd Parquet, one directory
    per layer (``layer=<name>``), readable with ``read_layer(layout='partitioned')``.

    ``mode``: ``append`` (incremental), ``overwrite`` or ``ignore`` (skip
    when the dataset exists).
    """
    df.write.mode(mode).option("compression", compression).partitionBy("layer").parquet(path)
    return path


def write_layer_file(df: DataFrame, path: str, overwrite: bool = False, compression: str = "zstd") -> str:
    """One layer to its own dataset; an existing one is kept unless ``overwrite``."""
    df.write.mode("overwrite" if overwrite else "ignore").option("compression", compression).parquet(path)
    return path
