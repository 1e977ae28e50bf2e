"""Link extraction from stored index pages and reachability over links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import anchor_hrefs, is_directory_page, is_kept_link, resolve_link
from ..session import discard, materialised, scratch_path


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per kept link of every page, resolved against the page URL.

    ``pos`` is the 0-based position of the anchor in the page.  Pages are
    processed whole; the work is split by page, never by link.
    """
    keep = [c for c in pages.columns if c != html]
    return (pages.select(*keep, F.posexplode(anchor_hrefs(F.col(html))).alias("pos", "href"))
            .where(is_kept_link(F.col("href")))
            .withColumn("pos", F.col("pos").cast("bigint"))
            .withColumn("link", resolve_link(F.col(url), F.col("href"))))


def directory_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pages that are directory listings (URL ends '/', lists dirs/files)."""
    keep = [c for c in pages.columns if c != html]
    return (pages.select(*keep, anchor_hrefs(F.col(html)).alias("_hrefs"))
            .where(is_directory_page(F.col(url), F.col("_hrefs"))).drop("_hrefs"))


#: rounds of plain search before shortcuts are drawn; shortcuts of one length that a node has at most
PLAIN_ROUNDS, SHORTCUTS = 4, 8


class _Kept:
    """Tables written below the shared folder; ``drop`` deletes one that is no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            path, _ = self.paths.pop(id(f))
            discard(self.spark, path)


def _longer(shortcuts: DataFrame, limit: int) -> DataFrame:
    """Shortcuts of twice the length: (src, dst) of two that follow each other.

    A node gets none where it might have more than ``limit``: what follows its
    shortcuts is counted before anything is joined, so at most ``limit`` rows a
    node are made, whatever its degree.
    """
    degree = shortcuts.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    ahead = shortcuts.join(degree.withColumnRenamed("src", "dst"), "dst").groupBy("src").agg(F.sum("n").alias("n"))
    few = shortcuts.join(ahead.where(F.col("n") <= limit).select("src"), "src", "left_semi")
    then = shortcuts.select(F.col("src").alias("dst"), F.col("dst").alias("to"))
    return few.join(then, "dst").select("src", F.col("to").alias("dst")).where("src <> dst").distinct()


def reachable_in_rounds(edges: DataFrame, seeds: DataFrame, merge_every: int = 4, plain_rounds: int = PLAIN_ROUNDS,
                        shortcuts: int = SHORTCUTS) -> tuple[DataFrame, int]:
    """Nodes reachable from ``seeds`` over ``edges(src, dst)`` with their exact depth, and how many rounds it took.

    The first ``plain_rounds`` rounds are a plain search: the frontier meets the
    edges and nodes seen before are removed.  What is still open then is deep, and
    from there each round also joins shortcuts of the longest length with
    themselves, so after k rounds there are shortcuts over 2, 4 ... 2^k edges.  A
    node at any distance is a sum of such lengths away, so a chain of n nodes
    takes about log2 n rounds.  A node has at most ``shortcuts`` of each length
    (none rather than more), which bounds their number; where a path branches too
    much for them the search goes on by shorter ones, at worst edge by edge.

    Depths found over shortcuts are lengths of real walks, so never too small;
    a node whose depth falls joins the frontier again, and the search ends when a
    round improves nothing over the edges themselves: then all depths are exact.
    The frontier, depths and shortcuts are tables in the shared folder; those
    that a round replaces are deleted.  Nulls are no nodes.
    """
    keep = _Kept(edges.sparkSession)
    e = keep.write(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct(), "edges")
    visited = keep.write(seeds.select("node").where("node IS NOT NULL").distinct().withColumn("depth", F.lit(0)), "visited")
    frontier, recent, rounds = visited, [], 0
    while rounds < plain_rounds:
        rounds += 1
        seen = reduce(DataFrame.unionByName, recent, visited)
        found = frontier.join(e, frontier["node"] == e["src"]).select(F.col("dst").alias("node")).distinct()
        frontier = keep.write(found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(rounds)), "level")
        recent.append(frontier)
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, recent, visited), rounds
        if len(recent) == merge_every:
            merged = keep.write(reduce(DataFrame.unionByName, recent, visited), "visited")
            keep.drop(visited, *recent[:-1])
            visited, recent = merged, []
    depths = keep.write(reduce(DataFrame.unionByName, recent, visited), "depths")
    levels, longest = [e.withColumn("hops", F.lit(1))], e
    while True:
        rounds += 1
        if longest is not None:
            new = keep.write(_longer(longest, shortcuts), "shortcuts")
            longest = None if new.isEmpty() else new
        every = reduce(DataFrame.unionByName, levels)
        step = frontier.join(every, frontier["node"] == every["src"]).select(F.col("dst").alias("node"), (F.col("depth") + F.col("hops")).alias("depth"))
        if longest is not None:
            # nodes settled before meet the shortcuts that are new
            hops = 2 ** len(levels)
            step = step.unionByName(depths.join(longest, depths["node"] == longest["src"]).select(F.col("dst").alias("node"), (F.col("depth") + hops).alias("depth")))
            levels.append(longest.withColumn("hops", F.lit(hops)))
        best = step.groupBy("node").agg(F.min("depth").alias("depth"))
        known = depths.withColumnRenamed("depth", "_known")
        better = best.join(known, "node", "left").where("_known IS NULL OR depth < _known").select("node", "depth")
        before, frontier = frontier, keep.write(better, "frontier")
        if frontier.isEmpty():
            return depths, rounds
        old, depths = depths, keep.write(depths.join(frontier, "node", "left_anti").unionByName(frontier), "depths")
        keep.drop(old)
        if rounds > plain_rounds + 1:
            keep.drop(before)


def reachable(edges: DataFrame, seeds: DataFrame, merge_every: int = 4) -> DataFrame:
    """Nodes reachable from ``seeds`` over ``edges(src, dst)``, with their depth; see :func:`reachable_in_rounds`."""
    return reachable_in_rounds(edges, seeds, merge_every)[0]


def crawl(pages: DataFrame, seeds: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Files found from ``seeds(url)`` over stored ``pages``: file, folder (page or parent URL) and depth.

    A listing page's directory links (ending '/') are followed, its other links
    are files.  A page that is reached but is no listing is itself a file, in
    the folder above it; so is a seed that no page is stored for.  Directory
    links without a stored page lead nowhere.  A file named by several listings
    counts for each folder; ``depth`` is the smallest.
    """
    distinct = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).dropDuplicates(["url"])
    p = distinct.select("url", anchor_hrefs(F.col("html")).alias("hrefs"))
    p = p.select("url", is_directory_page(F.col("url"), F.col("hrefs")).alias("listing"), "hrefs")
    p = materialised(p, "pages")
    links = p.where("listing").select("url", F.explode("hrefs").alias("href")).where(is_kept_link(F.col("href")))
    links = materialised(links.select("url", resolve_link(F.col("url"), F.col("href")).alias("link")).distinct(), "links")
    steps = links.where(F.col("link").endswith("/")).select(F.col("url").alias("src"), F.col("link").alias("dst"))
    start = seeds.select(F.col("url").alias("node")).distinct()
    reached = materialised(reachable(steps, start), "reached").withColumnRenamed("node", "url")
    listed = reached.join(links.where(~F.col("link").endswith("/")), "url").select(F.col("link").alias("file"), F.col("url").alias("folder"), (F.col("depth") + 1).alias("depth"))
    known = reached.join(p.select("url", "listing"), "url", "left")
    alone = known.where((F.col("listing") == F.lit(False)) | (F.col("listing").isNull() & (F.col("depth") == 0)))
    above = F.concat(F.regexp_replace("url", r"/[^/]*$", ""), F.lit("/"))
    single = alone.select(F.col("url").alias("file"), above.alias("folder"), "depth")
    return listed.unionByName(single).groupBy("file", "folder").agg(F.min("depth").alias("depth"))


def local_path(page_url, link, base: str):
    """Where a linked file lands in the mirror: the page's folder plus the
    link's file name."""
    from ..functions.urls import destination_folder, url_basename
    return F.concat(destination_folder(page_url, F.lit(base.rstrip("/"))), F.lit("/"), url_basename(link))


def split_by_presence(links: DataFrame, files: DataFrame, base: str,
                      url: str = "url", link: str = "link") -> tuple[DataFrame, DataFrame]:
    """Resume for file links: (already present -> log them, still to fetch).

    A file link counts as present when a non-empty file exists at its
    mirror location; directory links (ending '/') are never files.  Both
    sides are joins on the path (semi / anti), no per-row lookups.
    """
    import re
    root = re.sub(r"^file:(//)?", "", base)
    file_links = links.where(~F.col(link).endswith("/")).withColumn("_local", local_path(F.col(url), F.col(link), root))
    present = (files.where(F.col("length") > 0)
               .select(F.regexp_replace("path", r"^file:(//)?", "").alias("_local")).distinct())
    done = file_links.join(present, "_local", "left_semi").drop("_local")
    todo = file_links.join(present, "_local", "left_anti").drop("_local")
    return done, todo
