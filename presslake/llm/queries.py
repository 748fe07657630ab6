"""The queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import additive_search, chroma, language, minhash, mixing, page_text, pieces, secrets, suffix_encoding, toxicity, trie_counts
from .common import read

#: A public vocabulary; read on the driver only.
PIECE_MODEL = os.environ.get("PRESSLAKE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op2_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no sound, so each vector is rendered as a recording."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rec_id"), F.col("embedding").alias("samples"))
    return chroma.matched(chroma.fingerprints(rows, chroma.tones))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(read(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op7_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    return suffix_encoding.encode(read(spark, sf_dir, "documents"), pieces.load(model))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    return trie_counts.token_counts(read(spark, sf_dir, "documents"), pieces.load(model))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_search.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (op1_secret_scans, op2_chroma_fingerprints, op3_mixing, op4_toxicity, op5_html_extraction, op6_language_id, op7_sentencepiece, op8_minhash_near_dedup, op9_token_counts, op10_ann)
}
ORACLE_SQL = {"op1_secret_scans": secrets.SQL, "op3_mixing": mixing.SQL, "op8_minhash_near_dedup": minhash.SQL, "op10_ann": additive_search.SQL}
