"""Adapter from the driver's tables to cadastral layers and file fixtures.

The driver ships TPC-H-like tables, not cadastral files.  Every fixture is
derived from those tables by a deterministic rule written twice: once as
Spark Column expressions (what the library runs) and once as DuckDB SQL
(what the oracle runs).  The two must stay formula-for-formula identical.

Codes (k >= 0):
  dep(k):  m = k mod 101; m < 19 -> '01'..'19'; 19 -> '2A'; 20 -> '2B';
           21..95 -> m; 96..99 -> '971'..'974'; 100 -> '976'
  code(k): dep(k) + (k div 101 mod 1000 on 3 digits | mod 100 on 2 digits)
  ck(x):   x mod 10100  (code() is unique on 0..10099)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import app_id

BASE_DATE = "2024-01-01"
N_COMMUNE_KEYS = 10100
COMMUNE_SIDE = 100
ROW_WIDTH = 100  # communes per row of the commune grid

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


_TABLE_HANDLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read handle of a driver table (schema discovered once per session)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (app_id(spark), path)
    if key not in _TABLE_HANDLES:
        _TABLE_HANDLES[key] = spark.read.parquet(path)
    return _TABLE_HANDLES[key]


# ---------------------------------------------------------------- codes ----

def dep_of_index(m: int) -> str:
    """dep() of the rule above for m = k mod 101 (plain Python)."""
    if m < 19:
        return f"{m + 1:02d}"
    if m in (19, 20):
        return "2A" if m == 19 else "2B"
    if m <= 95:
        return str(m)
    return str(m + 875) if m <= 99 else "976"


# generated from the rule, index m = k mod 101
DEP_BY_INDEX = tuple(dep_of_index(m) for m in range(101))


def dep_code(k: Column) -> Column:
    return F.element_at(F.lit(list(DEP_BY_INDEX)), (F.pmod(k, F.lit(101)) + 1).cast("int"))


def commune_code(k: Column) -> Column:
    n = F.floor(k / 101)
    suffix = F.when(F.pmod(k, F.lit(101)) >= 96, F.lpad(F.pmod(n, F.lit(100)).cast("string"), 2, "0")) \
        .otherwise(F.lpad(F.pmod(n, F.lit(1000)).cast("string"), 3, "0"))
    return F.concat(dep_code(k), suffix)


def ck(x: Column) -> Column:
    return F.pmod(x, F.lit(N_COMMUNE_KEYS))


def dep_sql(k: str) -> str:
    m = f"(({k}) % 101)"
    return (f"CASE WHEN {m} < 19 THEN lpad(CAST({m} + 1 AS VARCHAR), 2, '0') "
            f"WHEN {m} = 19 THEN '2A' WHEN {m} = 20 THEN '2B' "
            f"WHEN {m} <= 95 THEN CAST({m} AS VARCHAR) "
            f"WHEN {m} <= 99 THEN CAST({m} + 875 AS VARCHAR) ELSE '976' END")


def commune_sql(k: str) -> str:
    d = dep_sql(k)
    n = f"(({k}) // 101)"
    return (f"CASE WHEN length({d}) = 2 THEN {d} || lpad(CAST({n} % 1000 AS VARCHAR), 3, '0') "
            f"ELSE {d} || lpad(CAST({n} % 100 AS VARCHAR), 2, '0') END")


def ck_sql(x: str) -> str:
    return f"(({x}) % {N_COMMUNE_KEYS})"


# ---------------------------------------------------------- dates, bbox ----

def _dates(key: Column) -> list[Column]:
    created = F.date_add(F.lit(BASE_DATE).cast("date"), F.pmod(key, F.lit(365)).cast("int"))
    return [created.alias("created"), F.date_add(created, 30).alias("updated")]


def _dates_sql(key: str) -> str:
    c = f"(DATE '{BASE_DATE}' + CAST(({key}) % 365 AS INTEGER))"
    return f"{c} AS created, {c} + 30 AS updated"


def _bbox(x0: Column, y0: Column, side: int) -> Column:
    return F.struct(
        x0.cast("float").alias("xmin"), y0.cast("float").alias("ymin"),
        (x0 + side).cast("float").alias("xmax"), (y0 + side).cast("float").alias("ymax"),
    ).alias("geometry_bbox")


def _bbox_sql(x0: str, y0: str, side: int) -> str:
    return (f"{{'xmin': CAST({x0} AS FLOAT), 'ymin': CAST({y0} AS FLOAT), "
            f"'xmax': CAST({x0} + {side} AS FLOAT), 'ymax': CAST({y0} + {side} AS FLOAT)}} AS geometry_bbox")


def commune_bbox(k: Column) -> Column:
    return _bbox(F.pmod(k, F.lit(ROW_WIDTH)) * COMMUNE_SIDE,
                 F.floor(k / ROW_WIDTH) * COMMUNE_SIDE, COMMUNE_SIDE)


def commune_bbox_sql(k: str) -> str:
    return _bbox_sql(f"(({k}) % {ROW_WIDTH}) * {COMMUNE_SIDE}",
                     f"(({k}) // {ROW_WIDTH}) * {COMMUNE_SIDE}", COMMUNE_SIDE)


#: rings of the three commune shapes as offsets in the 100 x 100 square: whole, L, square with a hole
SHAPES = (
    (((0, 0), (100, 0), (100, 100), (0, 100), (0, 0)),),
    (((0, 0), (100, 0), (100, 50), (50, 50), (50, 100), (0, 100), (0, 0)),),
    (((0, 0), (100, 0), (100, 100), (0, 100), (0, 0)), ((20, 20), (20, 60), (60, 60), (60, 20), (20, 20))),
)


def commune_rings(k: Column) -> Column:
    """Rings of commune k (shape k mod 3) as flat coordinate arrays."""
    x0 = (F.pmod(k, F.lit(ROW_WIDTH)) * COMMUNE_SIDE).cast("double")
    y0 = (F.floor(k / ROW_WIDTH) * COMMUNE_SIDE).cast("double")

    def rings(shape: tuple) -> Column:
        return F.array(*[F.array(*[c for dx, dy in ring for c in (x0 + dx, y0 + dy)]) for ring in shape])

    m = F.pmod(k, F.lit(len(SHAPES)))
    return F.when(m == 0, rings(SHAPES[0])).when(m == 1, rings(SHAPES[1])).otherwise(rings(SHAPES[2]))


def commune_rings_sql(k: str) -> str:
    x0, y0 = f"(({k}) % {ROW_WIDTH}) * {COMMUNE_SIDE}", f"(({k}) // {ROW_WIDTH}) * {COMMUNE_SIDE}"
    each = ["[" + ", ".join("[" + ", ".join(f"CAST({x0} + {dx} AS DOUBLE), CAST({y0} + {dy} AS DOUBLE)" for dx, dy in ring) + "]"
                            for ring in shape) + "]" for shape in SHAPES]
    return f"CASE ({k}) % 3 WHEN 0 THEN {each[0]} WHEN 1 THEN {each[1]} ELSE {each[2]} END"


def child_bbox(k: Column, key: Column) -> Column:
    """Unit square strictly inside commune k, placed by the row's own key."""
    x0 = F.pmod(k, F.lit(ROW_WIDTH)) * COMMUNE_SIDE + 1 + F.pmod(key, F.lit(97))
    y0 = F.floor(k / ROW_WIDTH) * COMMUNE_SIDE + 1 + F.pmod(F.floor(key / 97), F.lit(97))
    return _bbox(x0, y0, 1)


def child_bbox_sql(k: str, key: str) -> str:
    x0 = f"((({k}) % {ROW_WIDTH}) * {COMMUNE_SIDE} + 1 + ({key}) % 97)"
    y0 = f"((({k}) // {ROW_WIDTH}) * {COMMUNE_SIDE} + 1 + (({key}) // 97) % 97)"
    return _bbox_sql(x0, y0, 1)


def _two_letters(k: Column) -> Column:
    return F.concat(F.char(F.pmod(k, F.lit(26)) + 65), F.char(F.pmod(F.floor(k / 26), F.lit(26)) + 65))


def _two_letters_sql(k: str) -> str:
    return f"(chr(CAST(({k}) % 26 + 65 AS INTEGER)) || chr(CAST((({k}) // 26) % 26 + 65 AS INTEGER)))"


# --------------------------------------------------------------- layers ----

def _with_codes(df: DataFrame, k: Column) -> DataFrame:
    """Stage commune index and commune code as columns of the layer rows."""
    return df.withColumn("_k", k).withColumn("_com", commune_code(F.col("_k")))


def _parcel_id() -> Column:
    return F.concat(F.col("_com"), F.lit("000"), F.col("l_returnflag"), F.col("l_linestatus"),
                    F.col("l_linenumber").cast("string"))


def _parcel_id_sql() -> str:
    return (f"({commune_sql(ck_sql('l_partkey'))} || '000' || l_returnflag || l_linestatus "
            f"|| CAST(l_linenumber AS VARCHAR))")


def layer(spark: SparkSession, sf_dir: str, name: str, with_geometry: bool = False) -> DataFrame:
    """One cadastral layer as its source file would hold it."""
    t = lambda n: table(spark, sf_dir, n)
    s = lambda v: F.lit(v).cast("string")
    com = F.col("_com")
    kk = F.col("_k")
    if name == "communes":
        k = F.col("c_custkey")
        df = _with_codes(t("customer"), ck(k)).select(
            com.alias("id"), F.col("c_name").alias("nom"), *_dates(k), commune_bbox(kk), kk.alias("_shape"))
    elif name == "feuilles":
        k = F.col("o_orderkey")
        df = _with_codes(t("orders"), ck(F.col("o_custkey"))).select(
            F.concat(com, k.cast("string")).alias("id"), com.alias("commune"),
            s("000").alias("prefixe"), _two_letters(k).alias("section"),
            F.lpad(F.pmod(k, F.lit(10000)).cast("string"), 4, "0").alias("numero"),
            F.col("o_orderstatus").alias("qualite"), F.col("o_orderpriority").alias("modeConfec"),
            s("1000").alias("echelle"), *_dates(k), child_bbox(kk, k))
    elif name == "lieux_dits":
        k = F.col("s_suppkey")
        df = _with_codes(t("supplier"), ck(k)).select(
            F.col("s_name").alias("nom"), com.alias("commune"), *_dates(k), child_bbox(kk, k))
    elif name in ("prefixes_sections", "sections"):
        k = F.col("p_partkey")
        cols = [F.concat(com, F.lit("000"), k.cast("string")).alias("id"), com.alias("commune"),
                s("000").alias("prefixe")]
        if name == "prefixes_sections":
            cols += [F.col("p_brand").alias("ancienne")]
        else:
            cols += [F.col("p_type").alias("code"), *_dates(k)]
        df = _with_codes(t("part"), ck(k)).select(*cols, child_bbox(kk, k))
    elif name == "parcelles":
        k = F.col("l_orderkey")
        df = _with_codes(t("lineitem"), ck(F.col("l_partkey"))).select(
            _parcel_id().alias("id"), com.alias("commune"), s("000").alias("prefixe"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("section"),
            F.col("l_linenumber").cast("string").alias("numero"),
            F.floor(F.col("l_quantity")).cast("bigint").alias("contenance"), *_dates(k),
            child_bbox(kk, k))
    elif name == "batiments":
        k = F.col("o_orderkey")
        df = _with_codes(t("orders"), ck(F.col("o_custkey"))).select(
            F.col("o_orderstatus").alias("type"), s(None).alias("nom"),
            com.alias("commune"), *_dates(k), child_bbox(kk, k))
    elif name == "subdivisions_fiscales":
        k = F.col("l_orderkey")
        df = _with_codes(t("lineitem"), ck(F.col("l_partkey"))).select(
            F.concat(F.lit("SF"), k.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("id"),
            F.when(F.pmod(k, F.lit(7)) == 0, s(None)).otherwise(_parcel_id()).alias("parcelle"),
            F.col("l_returnflag").alias("lettre"), *_dates(k), child_bbox(kk, k))
    else:
        raise ValueError(f"unknown layer {name!r}")
    if with_geometry:
        from ..functions.geometry import bbox_polygon_wkb, rings_wkb
        if name == "communes":
            df = df.withColumn("geometry", rings_wkb(commune_rings(F.col("_shape"))))
        else:
            df = df.withColumn("geometry", bbox_polygon_wkb(F.col("geometry_bbox")))
    return df.drop("_shape")


def layers(spark: SparkSession, sf_dir: str, with_geometry: bool = False) -> dict[str, DataFrame]:
    return {n: layer(spark, sf_dir, n, with_geometry) for n in S.LAYERS}


def layer_sql(name: str) -> str:
    """DuckDB SELECT producing the same layer (geometry bytes omitted)."""
    if name == "communes":
        k = ck_sql("c_custkey")
        return (f"SELECT {commune_sql(k)} AS id, c_name AS nom, {_dates_sql('c_custkey')}, {commune_bbox_sql(k)} "
                f"FROM customer")
    if name == "feuilles":
        k = "o_orderkey"
        com = commune_sql(ck_sql("o_custkey"))
        return (f"SELECT {com} || CAST({k} AS VARCHAR) AS id, {com} AS commune, '000' AS prefixe, "
                f"{_two_letters_sql(k)} AS section, lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') AS numero, "
                f"o_orderstatus AS qualite, o_orderpriority AS \"modeConfec\", '1000' AS echelle, "
                f"{_dates_sql(k)}, {child_bbox_sql(ck_sql('o_custkey'), k)} FROM orders")
    if name == "lieux_dits":
        k = "s_suppkey"
        return (f"SELECT s_name AS nom, {commune_sql(ck_sql(k))} AS commune, {_dates_sql(k)}, "
                f"{child_bbox_sql(ck_sql(k), k)} FROM supplier")
    if name in ("prefixes_sections", "sections"):
        k = "p_partkey"
        com = commune_sql(ck_sql(k))
        head = f"SELECT {com} || '000' || CAST({k} AS VARCHAR) AS id, {com} AS commune, '000' AS prefixe, "
        if name == "prefixes_sections":
            return head + f"p_brand AS ancienne, {child_bbox_sql(ck_sql(k), k)} FROM part"
        return head + f"p_type AS code, {_dates_sql(k)}, {child_bbox_sql(ck_sql(k), k)} FROM part"
    if name == "parcelles":
        return (f"SELECT {_parcel_id_sql()} AS id, {commune_sql(ck_sql('l_partkey'))} AS commune, "
                f"'000' AS prefixe, l_returnflag || l_linestatus AS section, "
                f"CAST(l_linenumber AS VARCHAR) AS numero, CAST(floor(l_quantity) AS BIGINT) AS contenance, "
                f"{_dates_sql('l_orderkey')}, {child_bbox_sql(ck_sql('l_partkey'), 'l_orderkey')} FROM lineitem")
    if name == "batiments":
        return (f"SELECT o_orderstatus AS type, CAST(NULL AS VARCHAR) AS nom, "
                f"{commune_sql(ck_sql('o_custkey'))} AS commune, {_dates_sql('o_orderkey')}, "
                f"{child_bbox_sql(ck_sql('o_custkey'), 'o_orderkey')} FROM orders")
    if name == "subdivisions_fiscales":
        return (f"SELECT 'SF' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, "
                f"CASE WHEN l_orderkey % 7 = 0 THEN CAST(NULL AS VARCHAR) ELSE {_parcel_id_sql()} END AS parcelle, "
                f"l_returnflag AS lettre, {_dates_sql('l_orderkey')}, "
                f"{child_bbox_sql(ck_sql('l_partkey'), 'l_orderkey')} FROM lineitem")
    raise ValueError(f"unknown layer {name!r}")


# ------------------------------------------------ manifest, log, files ----

def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, format, millesime, source): every 10th format, 7th vintage
    and 13th source blank; even pages 'shp', odd pages 'edigeo'."""
    pid = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        pid,
        F.when(F.pmod(pid, F.lit(10)) == 0, F.lit("")).when(F.pmod(pid, F.lit(2)) == 0, F.lit("shp"))
        .otherwise(F.lit("edigeo")).alias("format"),
        F.when(F.pmod(pid, F.lit(7)) == 0, F.lit("")).otherwise(F.lit(S.DEFAULT_MILLESIME)).alias("millesime"),
        F.when(F.pmod(pid, F.lit(13)) == 0, F.lit("")).otherwise(F.col("url")).alias("source"))


MANIFEST_SQL = (f"SELECT page_id, CASE WHEN page_id % 10 = 0 THEN '' WHEN page_id % 2 = 0 THEN 'shp' "
                f"ELSE 'edigeo' END AS format, CASE WHEN page_id % 7 = 0 THEN '' ELSE '{S.DEFAULT_MILLESIME}' END AS millesime, "
                f"CASE WHEN page_id % 13 = 0 THEN '' ELSE url END AS source FROM pages")


def download_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(F.pmod(F.col("page_id"), F.lit(3)) == 0).select("url")


LOG_SQL = "SELECT url FROM pages WHERE page_id % 3 = 0"

MIRROR_ROOT = "/mirror"
MIRROR_DIR = MIRROR_ROOT + "/files.example.org/shp/departements/"
FILE_KINDS = S.LAYERS + ("other",)


def _file_stem(k: Column, cust: Column) -> Column:
    d = dep_code(cust)
    name = F.element_at(F.lit(list(FILE_KINDS)), (F.pmod(k, F.lit(9)) + 1).cast("int"))
    return F.concat(F.lit(MIRROR_DIR), d, F.lit("/cadastre-"), d, F.lit("-"), name, F.lit("-"), k.cast("string"))


def _file_stem_sql() -> str:
    d = dep_sql("o_custkey")
    kinds = "[" + ", ".join(f"'{n}'" for n in FILE_KINDS) + "]"
    return (f"'{MIRROR_DIR}' || {d} || '/cadastre-' || {d} || '-' || {kinds}[o_orderkey % 9 + 1] "
            f"|| '-' || CAST(o_orderkey AS VARCHAR)")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror tree listing shaped like the ``binaryFile`` source
    (path, modificationTime, length): one shapefile per order (``.SHP`` for
    odd keys), empty when key mod 11 = 0; a ``.cpg`` sidecar when key mod
    4 = 0; a converted ``.parquet`` twin when key mod 6 = 0."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(
        k, _file_stem(k, F.col("o_custkey")).alias("_stem"),
        F.col("o_orderdate").alias("modificationTime"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit(0)).otherwise(F.floor("o_totalprice")).cast("bigint").alias("_len"))
    shp = o.select(F.concat("_stem", F.when(F.pmod(k, F.lit(2)) == 1, F.lit(".SHP")).otherwise(F.lit(".shp")))
                   .alias("path"), "modificationTime", F.col("_len").alias("length"))
    cpg = o.where(F.pmod(k, F.lit(4)) == 0).select(
        F.concat("_stem", F.lit(".cpg")).alias("path"), "modificationTime", F.lit(5).cast("bigint").alias("length"))
    pq = o.where(F.pmod(k, F.lit(6)) == 0).select(
        F.concat("_stem", F.lit(".parquet")).alias("path"), "modificationTime", (F.col("_len") * 2).alias("length"))
    return shp.unionByName(cpg).unionByName(pq)


def file_listing_sql() -> str:
    st = _file_stem_sql()
    ln = "CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE floor(o_totalprice) END AS BIGINT)"
    return (f"SELECT {st} || CASE WHEN o_orderkey % 2 = 1 THEN '.SHP' ELSE '.shp' END AS path, "
            f"o_orderdate AS \"modificationTime\", {ln} AS length FROM orders "
            f"UNION ALL SELECT {st} || '.cpg', o_orderdate, CAST(5 AS BIGINT) FROM orders WHERE o_orderkey % 4 = 0 "
            f"UNION ALL SELECT {st} || '.parquet', o_orderdate, {ln} * 2 FROM orders WHERE o_orderkey % 6 = 0")


def mirror_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, length) of a small mirror tree, one file a supplier: some empty, some with hidden names, several folders deep."""
    k = F.col("s_suppkey")
    hidden = F.when(F.pmod(k, F.lit(7)) == 3, F.lit(".")).when(F.pmod(k, F.lit(7)) == 5, F.lit("_")).otherwise(F.lit(""))
    ext = F.when(F.pmod(k, F.lit(10)) == 9, F.lit(".zip")).when(F.pmod(k, F.lit(2)) == 1, F.lit(".SHP")).otherwise(F.lit(".shp"))
    folder = F.concat(F.lit("shp/"), dep_code(k), F.when(F.pmod(k, F.lit(3)) == 0, F.lit("/a b/c")).otherwise(F.lit("")))
    length = F.when(F.pmod(k, F.lit(4)) == 0, F.lit(0)).otherwise(F.pmod(k, F.lit(1000)))
    return table(spark, sf_dir, "supplier").select(F.concat(folder, F.lit("/"), hidden, F.lit("cadastre-"), k.cast("string"), ext).alias("path"), length.cast("bigint").alias("length"))


MIRROR_FILES_SQL = (f"SELECT 'shp/' || {dep_sql('s_suppkey')} || CASE WHEN s_suppkey % 3 = 0 THEN '/a b/c' ELSE '' END || '/' || "
                    f"CASE s_suppkey % 7 WHEN 3 THEN '.' WHEN 5 THEN '_' ELSE '' END || 'cadastre-' || s_suppkey || "
                    f"CASE WHEN s_suppkey % 10 = 9 THEN '.zip' WHEN s_suppkey % 2 = 1 THEN '.SHP' ELSE '.shp' END AS path, "
                    f"CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_suppkey % 1000 END AS BIGINT) AS length FROM supplier")


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst) over part keys, two edges a row; has cycles.

    k div 3 -> k, but from the unlinked node -1 - (k div 3) when k mod 5 = 0;
    k -> k div 3 when k mod 4 = 0, else to a leaf of its own, 10^12 + k.
    """
    k = F.col("p_partkey").cast("bigint")
    up = F.floor(k / 3).cast("bigint")
    part = table(spark, sf_dir, "part")
    fwd = part.select(F.when(F.pmod(k, F.lit(5)) != 0, up).otherwise(-1 - up).alias("src"), k.alias("dst"))
    back = part.select(k.alias("src"), F.when(F.pmod(k, F.lit(4)) == 0, up).otherwise(k + 10**12).alias("dst"))
    return fwd.unionByName(back)


LINK_EDGES_SQL = ("SELECT CASE WHEN p_partkey % 5 <> 0 THEN p_partkey // 3 ELSE -1 - p_partkey // 3 END AS src, p_partkey AS dst FROM part "
                  "UNION ALL SELECT p_partkey AS src, CASE WHEN p_partkey % 4 = 0 THEN p_partkey // 3 ELSE p_partkey + 1000000000000 END AS dst FROM part")

#: one more page, of links that are hard to read, added to the pages (page_id -1)
EDGE_URL = "https://root.example/"
EDGE_HTML = """<html><body><a href='../'>up</a><a href="my file.zip">1</a><a href="it's.zip">2</a>\
<a data-href="bad.zip" href="good.zip">3</a><a title="a > b" href=x.zip>4</a><a href=" sp.zip">5</a>\
<a href="q&#38;a.zip">6</a><a href='say &quot;hi&quot;.zip'>7</a><a name="n">8</a><A HREF = "sub/">9</A></body></html>"""

#: and a page (page_id -2) with a tag of a megabyte and one that never ends
LONG_URL, LONG_TAIL = "https://long.example/", '<a href="z.zip">2</a><a '
LONG_REPEATS = (("b ", 500_000), ("c", 20_000))


def _long_html(repeat, text, join):
    (word, n), (end, m) = LONG_REPEATS
    return join(text("<a "), repeat(text(word), n), text('href="y.zip">1</a>'), text(LONG_TAIL), repeat(text(end), m))


def pages_with_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, the page of hard links and the page of long tags."""
    long_html = _long_html(F.repeat, F.lit, F.concat)
    own = [spark.range(1).select(F.lit(k).cast("bigint").alias("page_id"), F.lit(url).alias("url"), html.alias("html"))
           for k, url, html in ((-1, EDGE_URL, F.lit(EDGE_HTML)), (-2, LONG_URL, long_html))]
    return table(spark, sf_dir, "pages").select("page_id", "url", "html").unionByName(own[0]).unionByName(own[1])


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LONG_SQL = _long_html(lambda t, n: f"repeat({t}, {n})", sql_text, lambda *parts: " || ".join(parts))
PAGES_SQL = (f"SELECT page_id, url, html FROM pages UNION ALL SELECT CAST(-1 AS BIGINT), {sql_text(EDGE_URL)}, {sql_text(EDGE_HTML)} "
             f"UNION ALL SELECT CAST(-2 AS BIGINT), {sql_text(LONG_URL)}, {_LONG_SQL}")

SITE = "https://site.example/"


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as one site that can be crawled: page n has the URL
    ``SITE``n/ (n mod 5 = 0 and n > 0: ``SITE``n, no listing) and links, besides
    its own, to the folders 2n + 1 and 2n + 2, back to n div 2, and to a file."""
    n = F.col("page_id")
    to = lambda k: F.concat(F.lit('<a href="/'), k.cast("string"), F.lit('/">d</a>'))
    extra = F.concat(to(n * 2 + 1), to(n * 2 + 2), to(F.floor(n / 2)), F.lit('<a href="f'), n.cast("string"), F.lit('.zip">f</a>'))
    slash = F.when((F.pmod(n, F.lit(5)) == 0) & (n > 0), F.lit("")).otherwise(F.lit("/"))
    return table(spark, sf_dir, "pages").select(F.concat(F.lit(SITE), n.cast("string"), slash).alias("url"), F.concat(extra, F.col("html")).alias("html"))
