"""From raw documents to checked token ids: language, toxicity, near copies, benchmark leaks, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result to the shared folder and reads it as the next one's docs.
All stages but the last return the columns of documents.

Null, empty and repeated rows: a text without a letter has no language and goes
in the first stage; repeated rows are one group of copies.  Empty tables pass
through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import decontaminate, lang_id, near_dup, sp_codec, toxicity
from parcelflow.llm.common import crc_mod4, prepared, table, written
from parcelflow.llm.queries import PIECE_MODEL

#: a document whose best language scores less is rejected
LEAST_LANGUAGE = 0.4

#: learned models and tokenizers have no SQL form; tests compare with brute force
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones are written in."""
    prepared(spark)
    net = lang_id.fit(docs.where(F.coalesce(crc_mod4() != 2, F.lit(True))))
    p = lang_id.predicted(net, docs)
    return docs.where((p["lang_pred"] != "und") & (p["score"] >= LEAST_LANGUAGE))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic."""
    prepared(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scored(model, docs) < toxicity.THRESHOLD)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepared(spark)
    return near_dup.first_of_each(docs).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    prepared(spark)
    return docs.where(F.size(decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))) == 0)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    prepared(spark)
    return sp_codec.encode_decode(docs, PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxic),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("sentencepiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
