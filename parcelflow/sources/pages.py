"""Stored index pages: (url, html[, page_id]) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages kept from a crawl (one row per page; the HTML is never split)."""
    df = spark.read.format(fmt).load(path)
    missing = {"url", "html"} - set(df.columns)
    if missing:
        raise ValueError(f"pages need columns url and html, missing {sorted(missing)}")
    return df
