"""Connected components of a link table, by contraction.

Tasks first join what they can: a union-find over a bounded number of their
links turns those into stars.  In every round each node then points to its
smallest neighbour if that is smaller than itself, and links are redrawn
between the targets; links within one target vanish.  The number of links falls
by a constant factor a round; small graphs need one or two.  Only tables in the
shared folder are kept between rounds, and nothing but whether any link is left
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: links that a task joins at once
LINKS = 200_000


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of a task as (node, smallest node connected to it), in runs of ``LINKS``."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    def stars() -> pd.DataFrame:
        out = [(x, r) for x in list(root) if (r := find(x)) != x]
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    n = 0
    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist(), strict=True):
            a, c = find(u), find(v)
            root[max(a, c)] = min(a, c)
        n += len(b)
        if n >= LINKS:
            yield stars()
            root.clear()
            n = 0
    if root:
        yield stars()


def _both_ways(links: DataFrame) -> DataFrame:
    stars = links.where("u <> v").mapInPandas(_stars, "u bigint, v bigint")
    both = stars.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x"))
    return written(both.select("x.u", "x.v").distinct(), "links")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``links``; equal labels: connected.  Links to null or itself are left out."""
    left = _both_ways(links.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")))
    rounds: list[DataFrame] = []
    while not rounds or not left.isEmpty():
        up = left.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        up = written(up, "parents")
        rounds.append(up)
        of_v = up.select(F.col("u").alias("v"), F.col("p").alias("q"))
        left = _both_ways(left.join(up, "u").join(of_v, "v").select(F.col("p").alias("u"), F.col("q").alias("v")))
    label = rounds[0].select(F.col("u").alias("node"), F.col("p").alias("label"))
    for up in rounds[1:]:
        moved = up.select(F.col("u").alias("label"), F.col("p").alias("to"))
        label = label.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return written(label, "labels")
