"""Manifest (TSV) and download-log readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

LOG_DOC = T.StructType([T.StructField(S.LOG_KEY, T.ArrayType(T.StringType())),
                        T.StructField("_corrupt_record", T.StringType())])
LOG_LINES = T.StructType([T.StructField("url", T.StringType())])
EMPTY_LOG = "url string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated manifest with a header line (UTF-8), all strings."""
    return spark.read.csv(path, sep="\t", header=True, encoding="UTF-8", inferSchema=False)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def log_state(spark: SparkSession, path: str) -> str:
    """'absent', 'corrupt' (not the JSON document it should be) or 'valid'."""
    if not _exists(spark, path):
        return "absent"
    return "corrupt" if _document(spark, path).where(F.col("_corrupt_record").isNotNull() | F.col(S.LOG_KEY).isNull()).limit(1).count() else "valid"


def _document(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(LOG_DOC).option("multiLine", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def read_log(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Done URLs, one row each (column ``url``).

    ``document``: the single JSON document ``{"downloaded_urls": [...]}``;
    ``lines``: a JSON-lines dataset of ``{"url": ...}`` records (what
    :func:`write_log` writes; it scales, a single document does not).
    An absent log reads empty; a corrupt document reads empty too (to
    resume, take ``operators.manifest.resume_log``, which rebuilds it).
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], EMPTY_LOG)
    if layout == "lines":
        return spark.read.schema(LOG_LINES).json(path).where(F.col("url").isNotNull())
    return (_document(spark, path).where(F.col("_corrupt_record").isNull())
            .select(F.explode(F.col(S.LOG_KEY)).alias("url")).where(F.col("url").isNotNull()))


def write_log(log: DataFrame, path: str) -> str:
    """Write a log version as JSON lines (a new directory per version)."""
    log.select("url").write.mode("overwrite").json(path)
    return path
