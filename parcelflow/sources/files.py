"""File listings: path, length and modification time; contents are never read."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..operators.inventory import extension_is
from ..session import arrow_file_system, scratch_path

_ENTRY = "path string, length bigint, modificationTime timestamp, folder boolean"


def _entries(folders: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What lies directly in each folder."""
    from pyarrow import fs

    for b in folders:
        for folder in b["path"]:
            system, where = arrow_file_system(folder)
            found = system.get_file_info(fs.FileSelector(where, allow_not_found=False))
            for lo in range(0, max(len(found), 1), 10_000):
                part = [f for f in found[lo : lo + 10_000] if f.type in (fs.FileType.File, fs.FileType.Directory)]
                yield pd.DataFrame({
                    "path": [f"{folder.rstrip('/')}/{f.base_name}" for f in part],
                    "length": [f.size or 0 for f in part],
                    "modificationTime": pd.Series([f.mtime.astimezone(timezone.utc).replace(tzinfo=None) for f in part], dtype="datetime64[us]"),
                    "folder": [f.type == fs.FileType.Directory for f in part],
                }).astype({"path": object, "length": "int64", "folder": bool})


def list_files(spark: SparkSession, root: str, ext: str | None = None) -> DataFrame:
    """All files at any depth below ``root``; with ``ext`` those ending so, whatever their case.

    Every file is listed, empty ones and those whose name begins with '.' or
    '_' too.  Folders are walked level by level: the folders of a level are
    dealt out and each is listed in a task; what they hold is written to the
    shared folder, and its folders are the next level.  The driver keeps only
    the number of levels.  Paths are those of the file system, unescaped, with its scheme.
    The root must exist and be reachable for every executor.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = spark.createDataFrame([(top,)], "path string")
    out = scratch_path(spark, "listing")
    depth = 0
    while True:
        step = f"{out}/level={depth}"
        level.repartition(n, "path").mapInPandas(_entries, _ENTRY).write.parquet(step)
        found = spark.read.schema(_ENTRY).parquet(step)
        level = found.where("folder").select("path")
        if level.isEmpty():
            break
        depth += 1
    files = spark.read.schema(_ENTRY + ", level int").parquet(out).where("NOT folder").select("path", "length", "modificationTime")
    return files.where(extension_is("path", ext)) if ext else files
