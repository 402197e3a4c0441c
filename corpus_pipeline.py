"""The corpus pipeline: documents in, encoded documents out, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.decontaminate import without_contaminated
from tabloom.llm.jaccard_forest import one_of_each
from tabloom.llm.language_id import recognised
from tabloom.llm.line_dedup import without_repeated_lines
from tabloom.llm.piece_encoding import encode_texts
from tabloom.llm.words import bound_batches
from tabloom.session import scratch_path


#: Bytes of a batch of texts; workers of earlier stages stay in an executor's memory, so a stage sends little at once.
BATCH_BYTES = 2 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    bound_batches(spark, size=BATCH_BYTES)
    return recognised(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand, or nearly stand, further up; those left without text go."""
    return without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark table."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, with digests of the ids and of the text decoded from them."""
    bound_batches(spark, size=BATCH_BYTES)
    return encode_texts(docs, with_ids=True, with_decoded=False)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("encode", encode)]

#: Rank-order profiles, MinHash and SimHash have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
