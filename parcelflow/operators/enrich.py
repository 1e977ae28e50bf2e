"""Layer enrichment: vintage, département, commune and object-type columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.codes import commune_of_parcelle, departement_of


def _head(millesime: str, departement, commune, layer: str) -> list:
    cols = [F.lit(millesime).alias("millesime"), departement.alias("departement")]
    if commune is not None:
        cols.append(commune.alias("commune"))
    cols.append(F.lit(layer).alias("type_objet"))
    return cols


def enrich_layer(df: DataFrame, layer: str, millesime: str = S.DEFAULT_MILLESIME) -> DataFrame:
    """Prepend the derived columns to every column of the layer.

    * ``communes``: the commune code is the feature's own ``id``.
    * ``subdivisions_fiscales``: located rows take département and commune
      from their ``parcelle``; rows without a parcel get the placeholder
      codes.  Both branches come from a single scan of the layer.
    * every other layer carries a ``commune`` column.
    """
    if layer == "communes":
        head = _head(millesime, departement_of("id"), F.col("id"), layer)
    elif layer == "subdivisions_fiscales":
        located = F.col("parcelle").isNotNull()
        head = _head(
            millesime,
            F.when(located, departement_of("parcelle")).otherwise(F.lit(S.UNLOCATED_DEPARTEMENT)),
            F.when(located, commune_of_parcelle("parcelle")).otherwise(F.lit(S.UNLOCATED_COMMUNE)),
            layer,
        )
    elif layer in S.LAYERS:
        head = _head(millesime, departement_of("commune"), None, layer)
    else:
        raise ValueError(f"unknown layer {layer!r}")
    return df.select(*head, "*")


def split_subdivisions(df: DataFrame, millesime: str = S.DEFAULT_MILLESIME) -> tuple[DataFrame, DataFrame]:
    """The two disjoint, exhaustive branches of the subdivisions layer."""
    enriched = enrich_layer(df, "subdivisions_fiscales", millesime)
    return (enriched.where(F.col("parcelle").isNotNull()),
            enriched.where(F.col("parcelle").isNull()))


def sort_layer(df: DataFrame) -> DataFrame:
    """Two-key order (departement, commune) of the per-layer tables.

    A hash of the row comes last, so that the range partitioner can split one
    commune's rows over many tasks.  Only meaningful when a layer table is
    materialised on its own; the export sorts by its own keys.
    """
    keyed = df.withColumn("_tb", F.xxhash64(*df.columns))
    return keyed.orderBy(F.col("departement").asc_nulls_last(), F.col("commune").asc_nulls_last(), "_tb").drop("_tb")


def enrich_mixed(df: DataFrame, millesime: str = S.DEFAULT_MILLESIME, layer_col: str = "layer") -> DataFrame:
    """Enrich rows of several layers at once, told apart by ``layer_col``.

    Same result per row as :func:`enrich_layer` on each layer separately;
    used where layers arrive interleaved (a stream of landed files, a batch
    of decoded shapefiles) so one scan serves all of them.  ``df`` must hold
    the attribute columns of :data:`schema.ATTRIBUTES` (NULL where absent).
    """
    layer = F.col(layer_col)
    located = F.col("parcelle").isNotNull()
    subdiv = layer == F.lit("subdivisions_fiscales")
    commune = (F.when(layer == F.lit("communes"), F.col("id"))
               .when(subdiv, F.when(located, commune_of_parcelle("parcelle")).otherwise(F.lit(S.UNLOCATED_COMMUNE)))
               .otherwise(F.col("commune")))
    return (df.withColumn("commune", commune)
              .withColumn("departement", F.when(subdiv & ~located, F.lit(S.UNLOCATED_DEPARTEMENT))
                          .otherwise(departement_of("commune")))
              .withColumn("millesime", F.lit(millesime))
              .withColumn("type_objet", layer))
