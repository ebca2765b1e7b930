"""A corpus pipeline of five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as parquet and read again as the next stage's
docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, langid, minmax_dedup, mixing, piece_transducer, secrets_battery

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of its n-grams that a language must know of a document; below, the document is rejected.
LEAST_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without an identifiable language; lang becomes the predicted one."""
    common.prepare(spark)
    docs = common.only(docs, *COLUMNS)
    found = langid.identify(docs, langid.train(docs)).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return found.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    docs = common.only(docs, *COLUMNS)
    return minmax_dedup.deduplicate(docs, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark of their kind; every document stays."""
    common.prepare(spark)
    docs = common.only(docs, *COLUMNS)
    out = secrets_battery.scan(docs, redact=lambda kind: f"[{secrets_battery.KINDS[kind].upper()}]")
    return out.select("doc_id", "text", "lang", "source", F.coalesce(F.length("text"), F.col("n_chars")).cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or the words of them, that the mix takes; a row for each copy."""
    return mixing.mixed_documents(common.only(docs, *COLUMNS))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with whether they decode to its text."""
    common.prepare(spark)
    return piece_transducer.encode(common.only(docs, *COLUMNS)).select("doc_id", "lang", "source", "n_tokens", "round_trip", "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]
#: Language identification, sketches and transducers are not expressible in SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and the one before it then removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        done, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.cut(docs)
            common.discard(done)
    return docs
