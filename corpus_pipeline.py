"""A corpus job: identify languages, drop near copies, drop benchmark text, mix sources, write token files.

Each stage takes the documents its predecessor kept and returns those it keeps, with their columns; the
last one returns what it read back from its files.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import fm_index, language, mixing, ngram_join, token_files
from marlstone.llm.samples import remainder
from marlstone.session import release_shuffles


#: Rows that travel to a Python task at once: texts are long, and executors run several tasks.
BATCH_ROWS = 1000


def small_batches(stage):
    """The stage with bounded Arrow batches, whatever the session's default."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_shuffles(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, or without a letter) go; ``lang`` is the one told by the text.

    The network learns from documents whose crc32(doc_id) mod 4 is not 2, as the query does. Where none of
    these has a language nothing can be told, and ``lang`` stays as it was.
    """
    model = language.fit(docs.where(remainder("doc_id", 4) != 2))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = language.identify(docs, model).where("lang_pred <> 'und'")
    return told.select("row.*", "lang_pred").select(
        *[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


@small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of exact or near copies stays, the one of the smallest id."""
    return ngram_join.drop_linked(docs)


@small_batches
def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in twenty inside benchmark windows go."""
    found = fm_index.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where("NOT contaminated").select("row.*")


@small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    mixed = mixing.mix(docs)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")


@small_batches
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 per copy."""
    import public_tokenizers

    return token_files.token_digest(docs, public_tokenizers.path(token_files.TOKENIZER))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_text),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: A trained network and a tokenizer take part, which SQL cannot express; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written once to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            folder = token_files.shared_folder(spark)
            docs.write.option("compression", "zstd").parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
