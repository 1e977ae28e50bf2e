"""Nearest neighbours by randomly rotated one-bit codes.

A vector x is kept as its length and, for its direction o turned by a random
rotation, the signs of the coordinates (one bit each) and the scalar
a = <code, o>.  For a query q turned the same way, <code, q> / a estimates
<o, q>; the error is at most ``EPS`` |q| sqrt((1 - a^2) / a^2) / sqrt(D - 1)
with high probability.  Within a block of vectors, the vectors with the best
estimates are scored on the originals, which gives the k-th best score so far;
then every vector whose estimate and error bound reach that score is scored
too.  Nothing else limits the candidates.

Equal vectors are searched once, with their ``k + 1`` smallest ids, and so are
equal queries.  Queries and vectors are dealt into blocks by a hash; every
query block meets every vector block (the queries are a stated set, and each
pair costs D bits).  The k + 1 best of each block are merged by Spark.

Vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id; vectors of another length than the query's are
no candidates.  Rows with equal id and vector count once; a query's own id is
never its answer.  Ties go to the smaller id.  An empty table gives an empty
result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

EPS, FIRST = 1.9, 64
QUERY_BLOCK, VECTOR_BLOCK = 4096, 4096


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, a, and lengths of the rows of ``x`` (none zero)."""
    length = np.linalg.norm(x, axis=1)
    o = (x / length[:, None]) @ rotation(x.shape[1]).T
    return np.packbits(o > 0, axis=1), np.abs(o).sum(1) / np.sqrt(x.shape[1]), length


def estimate(codes: np.ndarray, a: np.ndarray, length: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and their error bounds for a query of length 1."""
    dim = queries.shape[1]
    turned = (queries @ rotation(dim).T).astype(np.float32)
    bits = np.unpackbits(codes, axis=1, count=dim).astype(np.float32)
    product = (2 * (turned @ bits.T) - turned.sum(1, keepdims=True)) / np.sqrt(dim)
    bound = EPS * length * np.sqrt(np.maximum(1 - a * a, 0)) / a / np.sqrt(max(dim - 1, 1))
    return product * (length / a).astype(np.float32), bound


def search_block(queries: np.ndarray, vectors: np.ndarray, codes: np.ndarray, a: np.ndarray, length: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every query the places of its k best vectors in the block and their scores, best first."""
    out = []
    n = len(vectors)
    for lo in range(0, len(queries), 128):
        q = queries[lo : lo + 128]
        est, bound = estimate(codes, a, length, q)
        size = np.linalg.norm(q, axis=1)
        m = min(n, max(FIRST, k))
        first = np.argpartition(-est, m - 1, axis=1)[:, :m]
        score = np.einsum("qmd,qd->qm", vectors[first], q)
        kth = -np.partition(-score, min(k, m) - 1, axis=1)[:, min(k, m) - 1] if n > k else np.full(len(q), -np.inf)
        reach = est + size[:, None] * bound >= kth[:, None] * (1 - 1e-6 * np.sign(kth[:, None]))
        np.put_along_axis(reach, first, True, axis=1)
        for r in range(len(q)):
            at = np.flatnonzero(reach[r])
            s = vectors[at] @ q[r]
            best = np.lexsort((ids[at], -s))[:k]
            out.append((at[best], s[best]))
    return out


def _rows(col: pd.Series, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), kind).reshape(len(col), width)


def takes_part(vec: Column) -> Column:
    finite = ~F.exists(vec, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)


def _index() -> Column:
    @F.pandas_udf("struct<vector:binary,code:binary,a:double,length:double>")
    def index(vec: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame(index=range(len(vec)), columns=["vector", "code", "a", "length"], dtype=object)
        sizes = vec.map(len).to_numpy()
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            x = np.stack([np.asarray(vec.iloc[i], np.float64) for i in at])
            codes, a, length = encode(x)
            for n, i in enumerate(at):
                out.iloc[i] = [x[n].tobytes(), codes[n].tobytes(), a[n], length[n]]
        return out.astype({"a": float, "length": float})

    return index


def search(table: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows of every query row, by inner product."""
    spark = table.sparkSession
    t = table.select(F.col(key).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("vec"), is_query.alias("asks"))
    t = t.where(F.col("id").isNotNull() & takes_part(F.col("vec"))).withColumn("u", F.xxhash64("vec"))
    nth = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    few = t.select("id", "vec", "u").withColumn("nth", nth).where(F.col("nth") <= k + 1)
    distinct = few.groupBy("vec", "u").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    ix = distinct.select("u", "ids", F.size("vec").alias("dim"), _index()(F.col("vec")).alias("x")).select("u", "ids", "dim", "x.*")
    ix = written(ix, "codes")
    asking = written(t.where("asks").select("u", "id").distinct(), "queries")
    asked = ix.join(asking.select("u").distinct(), "u", "left_semi").select("u", "dim", "vector")

    n_v, n_q = -(-ix.count() // VECTOR_BLOCK) or 1, -(-asking.select("u").distinct().count() // QUERY_BLOCK) or 1
    i, j = F.pmod(F.xxhash64("u", F.lit(2)), F.lit(n_q)).cast("int"), F.pmod(F.xxhash64("u", F.lit(3)), F.lit(n_v)).cast("int")
    left = asked.select(F.col("dim").alias("dim"), i.alias("i"), F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))).alias("j"), F.col("u").alias("u"), F.col("vector").alias("query"))
    right = ix.select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("i"), j.alias("j"), F.element_at("ids", 1).alias("first_id"), "ids", "vector", "code", "a", "length")

    def meet(key: tuple, qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(qs) and len(vs):
            dim = int(key[0])
            q, x = _rows(qs["query"], np.float64, dim), _rows(vs["vector"], np.float64, dim)
            codes = _rows(vs["code"], np.uint8, (dim + 7) // 8)
            got = search_block(q, x, codes, vs["a"].to_numpy(), vs["length"].to_numpy(), vs["first_id"].to_numpy(), k + 1)
            ids = vs["ids"].to_numpy()
            out = [(u, s, ids[p]) for u, (at, score) in zip(qs["u"], got, strict=True) for p, s in zip(at, score, strict=True)]
        return pd.DataFrame(out, columns=["u", "score", "ids"])

    keys = ("dim", "i", "j")
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "u bigint, score double, ids array<bigint>")
    by_score = [F.desc("score"), F.col("vec_id")]
    near = met.select("u", "score", F.explode("ids").alias("vec_id"))
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("u").orderBy(*by_score))).where(F.col("n") <= k + 1)
    near = near.join(asking.withColumnRenamed("id", "query_id"), "u").where("vec_id <> query_id")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*by_score)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
