"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, secrets are
redacted, sources are mixed to target weights, and what is left is encoded to SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Null and empty texts
pass through every stage once; rows without an id are judged like others but are copies of nothing; rows that repeat id and text are one
document from the second stage on; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslake.llm import minhash, mixing, pieces, secrets, suffix_encoding, toxicity
from presslake.llm.common import Scratch, read
from presslake.llm.queries import PIECE_MODEL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, with language, source and length (which tells a cut copy from a whole one); rows of a document taken twice are alike."""
    return suffix_encoding.encode(docs, pieces.load(PIECE_MODEL), ("lang", "source", "n_chars"))


STAGES = [("toxicity", drop_toxic), ("minhash_near_dedup", drop_copies), ("secret_scans", redact_secrets), ("mixing", mix_sources), ("sentencepiece", encode)]

#: A trained classifier and an automaton are no SQL; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. Each result but the last is written to the shared folder and read again; it goes when the next one is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            scratch = Scratch(spark)
            docs = scratch.store(docs)
            if before is not None:
                before.clear()
            before = scratch
    return docs
