"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "parcelflow", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster use the cluster's own."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # per-call Python call-site capture costs extra JVM round trips per Column
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PARCELFLOW_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def app_id(spark: SparkSession) -> str:
    """Key for what is kept per application (object ids recur after a session stops)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (remote session)
        return spark.client._session_id


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system Spark resolves it on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and is visible to every
    executor; without it this raises.  Only a local master, whose executors
    are the driver's own process, gets a private folder.
    """
    d = spark.conf.get(CHECKPOINT_KEY, None)
    if not d:
        try:
            d = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
        except Exception:  # noqa: BLE001 - no SparkContext (remote session)
            d = None
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors of {master!r} share")
        d = tempfile.mkdtemp(prefix="parcelflow-")
        spark.conf.set(CHECKPOINT_KEY, d)
    return _qualified(spark, d).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_file_system(path: str):
    """The pyarrow file system of a path that Spark wrote down, and the path within it; used inside tasks."""
    from pyarrow import fs

    local = re.match(r"file:(?://)?(?=/)|(?=/)", path)
    return (fs.LocalFileSystem(), path[local.end():]) if local else fs.FileSystem.from_uri(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a superseded copy that this application wrote below the shared folder."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``parcelflow`` importable in executor Python workers.

    Python UDFs, ``mapInPandas`` and ``applyInPandas`` functions are pickled
    by reference to this package, so executors need it on their path.  Like
    ``--py-files``, the package is zipped on the driver and distributed with
    ``addPyFile`` (once per SparkContext).
    """
    import zipfile

    key = app_id(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: no SparkContext
        sc = None
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="parcelflow-pkg-"), "parcelflow.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, parent))
    if sc is not None:
        sc.addPyFile(zpath)
    else:
        spark.addArtifacts(zpath, pyfile=True)
    _SHIPPED.add(key)
