"""From raw documents to token files: five stages, each on what its predecessor kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes it to the shared folder and
rereads it as the next stage's documents. All but the last return the columns of ``documents``.

The stages reject documents without a main language; keep the smallest ``doc_id`` of each group of
near-copies; drop documents that repeat the benchmark; repeat or leave out documents to meet the
sources' target weights; and write what is left as packed token ids, returning a row per document read back
from the files. The stages' operators define what happens to nulls, empty and long texts and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontamination, jaccard, language, mixing, tokens
from tallyloom.llm.queries import END_ID, tokenizer_path
from tallyloom.llm.shipping import ship
from tallyloom.scratch import written

# Workers of the session keep the ids of so many parts; later stages run beside them.
KEPT_PARTS = 100_000
# They encode less text at once than for token files alone: executors come here with a heap grown by the joins.
ENCODE_BYTES = 1 << 20


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return jaccard.keep_one_per_component(docs, jaccard.Rule(words=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    files = tokens.write_tokens(docs, tokenizer_path(), END_ID, kept=KEPT_PARTS, encode_bytes=ENCODE_BYTES)
    return tokens.read_tokens(files)


STAGES = [
    ("language_id", identify_languages),
    ("jaccard_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

# Viterbi labels, the hypergeometric tree and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
