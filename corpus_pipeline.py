"""A corpus pipeline over `documents`: each stage works on all that the one before it kept.

1. toxicity: documents that the classifier chain rejects go.
2. near_dedup: of each SimHash component one document stays, the one with the smallest doc_id.
3. decontaminate: documents of whose words 5 of 100 or more lie in benchmark windows go.
4. pii: personal data is replaced by surrogates in the texts that are left.
5. bpe: every text is encoded; the result has its ids' number and hash and the hash of what they decode to.

All stages but the last return the columns of `documents`. Each is written as Parquet in the shared folder and read again.

Defined cases, for every stage: null text counts as empty and stays null until it is encoded (no ids, the empty text's hashes); the toxicity
chain and the benchmark reject none of those, near_dedup keeps one of all texts without words, as they share a fingerprint. Texts of any
length are read whole. Repeated rows, a repeated doc_id included, are near copies of each other: one stays, of equal rows any. Of rows
without a doc_id one stays for each component that has no id. Ties go to the smaller doc_id, then fingerprint. Columns may have any names, those
that stages use inside included; they are kept as they are. An empty table stays empty through all stages; without labels nothing is toxic,
without a benchmark nothing is contaminated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import bpe, decontaminate, pii, queries, simhash, toxicity
from fieldloom.llm.common import remove, shared_dir, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs, queries.PII_KEY, count=None)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = bpe.encode(docs, queries.word_bpe_path(), keep=["doc_id"], decoded="decoded")
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: The stages need a trained model, XXH64 and a tokenizer, which SQL does not have; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
        docs = spark.read.parquet(path)
    return docs
