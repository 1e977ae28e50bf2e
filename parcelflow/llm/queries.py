"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, lang_id, license_scan, near_dup, ranked_search, sharding, sp_codec, sql, substring_dedup, token_files, toxicity, vector_search, whitening
from .common import crc_mod4, held_out, prepared, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = lang_id.fit(docs.where(F.coalesce(crc_mod4() != 2, F.lit(True))))
    out = docs.select("doc_id", held_out().alias("held_out"), lang_id.predicted(net, docs).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out().alias("held_out"), toxicity.scored(model, docs).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def file_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: <source>/<ten thousands>/<hundreds>/<doc_id>.txt.

    Ids divisible by 100 are licence files of their hundred, by 1,000 of their ten thousand.
    """
    k = F.col("doc_id")
    tens, hundreds = F.expr("cast(doc_id div 10000 as string)"), F.expr("cast(doc_id div 100 as string)")
    notice = F.concat(F.lit("LICENSE-"), k.cast("string"))
    path = F.when(k % 1000 == 0, F.concat_ws("/", "source", tens, notice)).when(k % 100 == 0, F.concat_ws("/", "source", tens, hundreds, notice))
    path = path.otherwise(F.concat_ws("/", "source", tens, hundreds, F.concat(k.cast("string"), F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(file_paths(table(spark, sf_dir, "documents")), keep=("doc_id",))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.encode_decode(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokens(table(spark, sf_dir, "documents"), BYTE_MODEL, end_id=2)


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"))


_QUERIES = (op1_decontamination, op2_language, op3_toxicity, op4_licenses, op5_sharding, op6_sentencepiece, op7_html_text, op8_vector_search, op9_token_files, op10_near_dup, op11_whitening, op12_ranked_search, op13_substring_dedup)


def _shipped(query: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepared(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _shipped(q) for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op12_ranked_search": sql.RANKED_SEARCH, "op13_substring_dedup": sql.SUBSTRING_DEDUP}
