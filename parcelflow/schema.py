"""Canonical data model of the unified cadastral dataset.

Everything here is a *fixed value*: the names, orders and codes must equal
the published layout so that a user switching over gets the same files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Layer names, in the order used for first-substring-hit classification of
# file names ("prefixes_sections" must be tested before "sections").
LAYERS = (
    "batiments",
    "communes",
    "feuilles",
    "lieux_dits",
    "parcelles",
    "prefixes_sections",
    "sections",
    "subdivisions_fiscales",
)

# Order in which the enriched layers are stacked into the unified view.
UNION_ORDER = (
    "sections",
    "subdivisions_fiscales",
    "communes",
    "feuilles",
    "lieux_dits",
    "prefixes_sections",
    "batiments",
    "parcelles",
)

# Table of the subdivisions without a parcel, and the tables kept sorted.
UNLOCATED_TABLE = "subdivisions_fiscales_sanscommune"
SORTED_TABLES = ("communes", "feuilles", "lieux_dits", "prefixes_sections", "sections", "subdivisions_fiscales")

DEFAULT_MILLESIME = "2025-04-01"

# Placeholder codes of features that carry no location attribute.
UNLOCATED_DEPARTEMENT = "000"
UNLOCATED_COMMUNE = "00000"

# Overseas prefix: a code starting with it keeps 3 characters as département.
OVERSEAS_PREFIX = "97"

# SRID by département.  Anything not listed in SRID_EXCLUDED gets
# SRID_DEFAULT; note the exclusion list holds "00", not "000".
SRID_DEFAULT = 2154
SRID_EXCLUDED = ("971", "972", "973", "974", "976", "00")
SRID_BY_DEPARTEMENT = (
    (("971", "972"), 5490),
    (("973",), 2972),
    (("974",), 2975),
    (("976",), 4471),
)
SRID_UNLOCATED = 0

# Export batches ("lots"): Corsica by name, the rest by numeric upper bound.
LOT_CORSICA = "2A_2B"
CORSICA = ("2A", "2B")
LOT_BOUNDS = (
    (10, "01_10"),
    (25, "11_25"),
    (40, "26_40"),
    (55, "41_55"),
    (70, "56_70"),
    (85, "71_85"),
    (95, "86_95"),
)
LOT_OVERSEAS = "971_976"  # everything numeric above the last bound
LOT_NAMES = (LOT_CORSICA,) + tuple(name for _, name in LOT_BOUNDS) + (LOT_OVERSEAS,)

# Length of the type_objet prefix used as third export sort key.
TYPE_PREFIX_LEN = 8

# Download log file name and its JSON key.
LOG_FILE_NAME = "downloads_completed.json"
LOG_KEY = "downloaded_urls"

# Text encoding of shapefile attributes (the sidecar text "88591").
DEFAULT_CHARSET = "ISO-8859-1"
# --- end of fixed values ----------------------------------------------------

BBOX_TYPE = T.StructType(
    [
        T.StructField("xmin", T.FloatType()),
        T.StructField("ymin", T.FloatType()),
        T.StructField("xmax", T.FloatType()),
        T.StructField("ymax", T.FloatType()),
    ]
)

# Canonical 23-column output, in published order.
CANONICAL = T.StructType(
    [
        T.StructField("millesime", T.DateType()),
        T.StructField("departement", T.StringType()),
        T.StructField("commune", T.StringType()),
        T.StructField("type_objet", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("parcelle", T.StringType()),
        T.StructField("numero", T.StringType()),
        T.StructField("prefixe", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("lettre", T.StringType()),
        T.StructField("nom", T.StringType()),
        T.StructField("created", T.DateType()),
        T.StructField("updated", T.DateType()),
        T.StructField("qualite", T.StringType()),
        T.StructField("modeConfec", T.StringType()),
        T.StructField("echelle", T.StringType()),
        T.StructField("ancienne", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("contenance", T.LongType()),
        T.StructField("geometry", T.BinaryType()),
        T.StructField("geometry_bbox", BBOX_TYPE),
        T.StructField("geom_srid", T.IntegerType()),
    ]
)
CANONICAL_COLUMNS = tuple(f.name for f in CANONICAL.fields)

# Columns added by enrichment (never read from layer files).
DERIVED = ("millesime", "departement", "type_objet", "geom_srid")

# Attribute columns a layer file may carry (superset; absent ones read NULL).
ATTRIBUTES = T.StructType(
    [f for f in CANONICAL.fields if f.name not in DERIVED]
)


def layer_schema(layer: str) -> T.StructType:
    """Declared read schema of one layer's files.

    ``communes`` and ``subdivisions_fiscales`` get their ``commune`` from
    another column, so the file schema must not carry one.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    drop = {"commune"} if layer in ("communes", "subdivisions_fiscales") else set()
    return T.StructType([f for f in ATTRIBUTES.fields if f.name not in drop])
