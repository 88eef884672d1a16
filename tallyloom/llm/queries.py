"""The corpus operators as queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import alignment, decontamination, jaccard, language, minhash, mixing, neighbours, periodic, secret_scan, suffixes, tokens, toxicity, warc
from tallyloom.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    _registered[function.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_registered)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_neighbours(spark, folder):
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest_neighbours(vectors, lambda vec_id: vec_id % 20 == 0)


@_query
def op2_language(spark, folder):
    docs = _table(spark, folder, "documents")
    labelled = language.label_languages(docs, language.fit_documents(docs))
    return labelled.select(F.col("id").alias("doc_id"), language.held_out("id").alias("held_out"), "lang_pred", "score")


@_query
def op3_warc(spark, folder):
    archives = warc.write_archives(warc.with_revisits(_table(spark, folder, "pages")))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op4_mixing(spark, folder):
    mixed = mixing.mixed_sizes(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op5_secret_scan(spark, folder):
    return secret_scan.secret_digest(secret_scan.find_secrets(_table(spark, folder, "documents")))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


END_ID = 2


@_query
def op6_token_files(spark, folder):
    files = tokens.write_tokens(_table(spark, folder, "documents"), tokenizer_path(), END_ID)
    return tokens.read_tokens(files)


@_query
def op7_jaccard_join(spark, folder):
    return jaccard.jaccard_components(_table(spark, folder, "documents"), jaccard.Rule(words=4, percent=85))


@_query
def op8_toxicity(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_toxicity(docs, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select(F.col("id").alias("doc_id"), toxicity.held_out("id").alias("held_out"), "score", predicted.alias("predicted"))


@_query
def op9_suffix_dedup(spark, folder):
    return suffixes.repeat_digest(suffixes.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text")))


@_query
def op10_decontamination(spark, folder):
    found = decontamination.benchmark_matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return decontamination.hits_per_document(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@_query
def op11_alignment(spark, folder):
    pieces = tokenizer_path("piece_bpe_32k.model")
    return alignment.alignment_digest(_table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path(), pieces)


@_query
def op12_minhash_near_dedup(spark, folder):
    return minhash.near_duplicates(_table(spark, folder, "documents"), minhash.Rule(words=4, percent=80))


@_query
def op13_periodic_runs(spark, folder):
    return periodic.run_digest(periodic.periodic_runs(periodic.with_planted_period(_table(spark, folder, "documents"))))
