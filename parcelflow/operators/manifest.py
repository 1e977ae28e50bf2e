"""Source-manifest planning with resume (download planning as a Spark job).

Network fetching itself is not a data operation and is not built; what is
built is everything relational around it: which manifest rows are planned,
filtered, skipped as already done or rejected, and the resume log.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.urls import normalize_seed, path_to_url
from ..sources.manifest import log_state, read_log, write_log

# --- fixed values: outcomes, in precedence order ---------------------------
MISSING_URL = "missing_url"
FILTERED = "filtered"
SKIPPED = "skipped"
PLANNED = "planned"
UNKNOWN_VINTAGE = "inconnu"
# ---------------------------------------------------------------------------


def clean_manifest(manifest: DataFrame) -> DataFrame:
    """Trim the three fields; without a vintage column 'inconnu', blank values stay blank."""
    if "source" not in manifest.columns:
        raise ValueError("manifest has no 'source' column")
    fmt = F.trim(F.col("format")) if "format" in manifest.columns else F.lit("")
    vintage = (F.trim(F.coalesce(F.col("millesime"), F.lit("")))
               if "millesime" in manifest.columns else F.lit(UNKNOWN_VINTAGE))
    return manifest.withColumn("source", F.trim(F.coalesce(F.col("source"), F.lit("")))) \
        .withColumn("format", F.coalesce(fmt, F.lit(""))).withColumn("millesime", vintage)


def _outcome(fmt_filter: str | None, has_format: bool, done: Column | None) -> Column:
    expr = F.when(F.length(F.col("source")) == 0, F.lit(MISSING_URL))
    if fmt_filter and has_format:
        expr = expr.when(F.col("format") != F.lit(fmt_filter), F.lit(FILTERED))
    if done is not None:
        expr = expr.when(done, F.lit(SKIPPED))
    return expr.otherwise(F.lit(PLANNED))


def plan_manifest(manifest: DataFrame, format_filter: str | None = None,
                  log: DataFrame | None = None) -> DataFrame:
    """Every manifest row with its normalised URL and its outcome.

    Precedence: missing URL, then format filter, then already in the log
    (only when a log is given, i.e. resume mode), else planned.  A filter
    on a manifest without a ``format`` column is ignored.  The log lookup is
    a left join on the URL against the distinct log URLs (planned by
    Catalyst; the log may be far larger than the manifest).
    """
    has_format = "format" in manifest.columns
    m = clean_manifest(manifest)
    m = m.withColumn("url", F.when(F.length("source") > 0, normalize_seed(F.col("source"))))
    done = None
    if log is not None:
        logged = log.select(F.col("url").alias("_logged")).distinct()
        m = m.join(logged, m["url"] == logged["_logged"], "left")
        done = F.col("_logged").isNotNull()
    out = m.withColumn("outcome", _outcome(format_filter, has_format, done))
    return out.drop("_logged") if log is not None else out


def resume_worklist(manifest: DataFrame, log: DataFrame, format_filter: str | None = None) -> DataFrame:
    """Seeds still to process: valid, matching the filter, not in the log."""
    m = clean_manifest(manifest).where(F.length("source") > 0)
    if format_filter and "format" in manifest.columns:
        m = m.where(F.col("format") == F.lit(format_filter))
    m = m.withColumn("url", normalize_seed(F.col("source")))
    return m.join(log.select("url").distinct(), "url", "left_anti")


def outcome_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("outcome").agg(F.count("*").alias("n"))


def manifest_formats(manifest: DataFrame) -> DataFrame:
    """Distinct non-empty formats, sorted."""
    if "format" not in manifest.columns:
        return manifest.sparkSession.createDataFrame([], "format string")
    f = F.trim(F.col("format"))
    return manifest.select(f.alias("format")).where(F.length("format") > 0).distinct().orderBy("format")


def append_log(log: DataFrame, urls: DataFrame) -> DataFrame:
    """Log after adding newly done URLs; each URL once."""
    return log.select("url").unionByName(urls.select("url")).dropDuplicates(["url"])


def rebuild_log(files: DataFrame, root: str) -> DataFrame:
    """Done URLs recovered from a mirror tree: non-empty files, minus the log.

    ``files`` is a listing (``path``, ``length``); the first directory below
    ``root`` is the host name.
    """
    prefix = re.sub(r"^file:(//)?", "", root).rstrip("/") + "/"
    path = F.regexp_replace(F.col("path"), r"^file:(//)?", "")
    rel = F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 30))
    name = F.substring_index(F.col("path"), "/", -1)
    return (files.where((F.col("length") > 0) & (name != F.lit(S.LOG_FILE_NAME)))
            .select(path_to_url(rel).alias("url")).where(F.col("url").isNotNull()))


def resume_log(spark: SparkSession, path: str, files: DataFrame, root: str, save_to: str | None = None) -> DataFrame:
    """The log to resume from: the stored one or, if it is absent or corrupt, one rebuilt from the mirror.

    ``files`` lists the mirror below ``root``.  A rebuilt log is written to
    ``save_to`` (JSON lines) when that is given, and read from there.
    """
    if log_state(spark, path) == "valid":
        return read_log(spark, path)
    rebuilt = rebuild_log(files, root).distinct()
    return read_log(spark, write_log(rebuilt, save_to), layout="lines") if save_to else rebuilt


# --- fixed values: per-file fetch results -----------------------------------
FETCH_SUCCESS = "success"
FETCH_FAILURE = "failure"
FETCH_DIRECTORY = "directory"  # the URL answered with a listing, not a file
# ---------------------------------------------------------------------------


def seed_outcomes(results: DataFrame, seed: str = "seed", outcome: str = "outcome") -> DataFrame:
    """Per seed: successes, failures and directory answers, and whether the
    seed may be logged as done (only when none of its files failed).

    A directory answer counts as neither success nor failure.  One grouped
    aggregation with map-side partial counts, so a seed holding most of the
    files is no hot spot.
    """
    o = F.col(outcome)
    return results.groupBy(seed).agg(
        F.count_if(o == FETCH_SUCCESS).alias("n_success"),
        F.count_if(o == FETCH_FAILURE).alias("n_failure"),
        F.count_if(o == FETCH_DIRECTORY).alias("n_directory"),
    ).withColumn("done", F.col("n_failure") == 0)
