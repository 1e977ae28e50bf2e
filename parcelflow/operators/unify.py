"""Union of enriched layers and projection to the canonical schema."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.codes import srid_of
from .enrich import enrich_layer, sort_layer, split_subdivisions

#: bytes of a layer's (compressed) files that a bucket takes, as a task sorts a bucket; and buckets at least
BUCKET_BYTES, LEAST_BUCKETS = 32 << 20, 16


def union_layers(enriched: Mapping[str, DataFrame] | list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column absent from a layer reads NULL."""
    frames = list(enriched.values()) if isinstance(enriched, Mapping) else list(enriched)
    if isinstance(enriched, Mapping):
        order = [n for n in S.UNION_ORDER if n in enriched] + [n for n in enriched if n not in S.UNION_ORDER]
        frames = [enriched[n] for n in order]
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform(df: DataFrame, srid_mode: str = "literal") -> DataFrame:
    """Fixed 23-column projection with the SRID derived from the département.

    Columns missing from every input are emitted as typed NULLs, so an empty
    or partial set of layers still yields the published schema.  Columns not
    in the canonical list are dropped.
    """
    present = set(df.columns)
    cols = []
    for f in S.CANONICAL.fields:
        if f.name == "geom_srid":
            cols.append(srid_of("departement", srid_mode).alias("geom_srid"))
        elif f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def unified_features(layers: Mapping[str, DataFrame], millesime: str = S.DEFAULT_MILLESIME,
                     srid_mode: str = "literal") -> DataFrame:
    """Raw layer frames -> enriched -> union -> canonical features."""
    enriched = {name: enrich_layer(df, name, millesime) for name, df in layers.items()}
    return conform(union_layers(enriched), srid_mode)


def backfill_section_parcelle(features: DataFrame) -> DataFrame:
    """Fill ``section``/``parcelle`` where the object itself defines them.

    A section's ``code`` is its section letter(s) and a parcel's ``id`` is the
    parcel reference, so both become retrievable by attribute without a
    spatial query.  Existing values are kept.
    """
    t = F.col("type_objet")
    return features.withColumn(
        "section", F.when(t == "sections", F.coalesce("section", "code")).otherwise(F.col("section"))
    ).withColumn(
        "parcelle", F.when(t == "parcelles", F.coalesce("parcelle", "id")).otherwise(F.col("parcelle"))
    )


def create_views(spark, union_df: DataFrame, features: DataFrame,
                 union_name: str = "source_union", unique_name: str = "source_unique") -> None:
    """Expose the stacked layers and the canonical features to SQL users."""
    union_df.createOrReplaceTempView(union_name)
    features.createOrReplaceTempView(unique_name)


def layer_tables(layers: Mapping[str, DataFrame], millesime: str = S.DEFAULT_MILLESIME) -> dict[str, DataFrame]:
    """The nine enriched tables: subdivisions without a parcel have their own."""
    out = {}
    for name, df in layers.items():
        if name == "subdivisions_fiscales":
            out[name], out[S.UNLOCATED_TABLE] = split_subdivisions(df, millesime)
        else:
            out[name] = enrich_layer(df, name, millesime)
    return out


def save_layer_tables(layers: Mapping[str, DataFrame], path: str, mode: str = "overwrite",
                      millesime: str = S.DEFAULT_MILLESIME, compression: str = "zstd") -> list[str]:
    """Write each of the nine tables to ``path/<table>``; six of them sorted."""
    names = []
    for name, df in layer_tables(layers, millesime).items():
        df = sort_layer(df) if name in S.SORTED_TABLES else df
        df.write.mode(mode).option("compression", compression).parquet(f"{path}/{name}")
        names.append(name)
    return names


def buckets_for(spark, paths: list[str], bucket_bytes: int | None = None) -> int:
    """How many buckets hold the largest of the datasets ``paths`` at ``bucket_bytes`` of its files a bucket; ``LEAST_BUCKETS`` at least."""
    size = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        size = max(size, p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength())
    return max(LEAST_BUCKETS, -(-size // (bucket_bytes or BUCKET_BYTES)))


def save_bucketed_tables(layers: Mapping[str, DataFrame], path: str, prefix: str, buckets: int,
                         millesime: str = S.DEFAULT_MILLESIME, compression: str = "zstd") -> list[str]:
    """Save the nine tables through the catalog as ``<prefix><table>``, below ``path``, bucketed and sorted by commune.

    All have the same buckets, so tables join, and group, by commune as they
    lie, without a shuffle.  Rows are dealt out to the buckets before they are
    written: one file a bucket.  A commune lies in one bucket whatever its size;
    where that is too much for a task, join the tables of
    :func:`save_layer_tables`, which Spark shuffles and can split.
    """
    names = []
    for name, df in layer_tables(layers, millesime).items():
        (df.repartition(buckets, "commune").write.mode("overwrite").format("parquet").option("compression", compression).option("path", f"{path}/{name}")
            .bucketBy(buckets, "commune").sortBy("commune").saveAsTable(prefix + name))
        names.append(prefix + name)
    return names
