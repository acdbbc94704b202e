"""A training corpus from ``documents``, stage by stage; each stage works on all that the one before it kept.

Every stage but the last returns the columns of ``documents``. Documents without a recognised language go, of each
group of near-duplicates one stays, documents that hold benchmark windows go, personal data is replaced in the texts
that stay, and their tokens are packed into sequences.

Edge cases, stage by stage. Language: null and empty texts, and texts without a letter or a known word or letter group,
go. Near-duplicates: of a group's rows the one of smallest doc_id stays, on a tie that of smallest text hash; rows
without an id come last in a group, and rows that share an id but not a group all stay. Decontamination and personal
data look at each row by itself; other columns, of any name, travel with their row (n_chars follows a changed text).
Packing: one row a piece. An empty table stays empty through every stage; texts of any length are read whole. Stages'
tables stay in the shared folder until it is cleared, so a run that loses executors can read them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.llm.common import crc_split, shared_dir, table
from genoloom.llm.decontaminate import drop_contaminated
from genoloom.llm.language import fit_language_model, keep_known
from genoloom.llm.packing import pack_documents
from genoloom.llm.pii import redact
from genoloom.llm.simhash import keep_one
from genoloom.llm.tokens import byte_bpe


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_language_model(docs.filter(~crc_split(F.col("doc_id"), 4, 2)).select("doc_id", "text", "lang"))
    return keep_known(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, byte_bpe())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: Language models and tokenizers can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
