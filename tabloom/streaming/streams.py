"""Streaming forms: calendar aggregation with late-data bounds, and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.operators.series import AGGREGATES
from tabloom.plans.prep import PreparationModel
from tabloom.plans.registry import ModelRegistry
from tabloom.session import scratch_path

# The calendar levels whose periods have one length.
WINDOWS = {"H": "1 hour", "D": "1 day"}


def read_stream(spark: SparkSession, path: str, schema: StructType | str, *, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def stream_by_period(df: DataFrame, ts: str, values: Sequence[str], level: str = "H", agg: str = "mean",
                     *, watermark: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    """Calendar grouping of a stream; rows later than the watermark are dropped.

    State is one row per open period, whatever the number of events.
    """
    fn = AGGREGATES[agg]
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    grouped = timed.groupBy(F.window(ts, WINDOWS[level]).alias("_w"), *by).agg(*[fn(F.col(v)).alias(v) for v in values])
    return grouped.select(*by, F.col("_w.start").alias(ts), *values)


def prepare_stream(df: DataFrame, model: PreparationModel) -> DataFrame:
    """The fitted preparation on a stream; all lookups are static tables."""
    return model.transform(df)


def score_stream(df: DataFrame, registry: ModelRegistry, name: str | None = None) -> DataFrame:
    return registry.predict(df, name)


def run_available(df: DataFrame, path: str, *, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Process everything available, write it to ``path`` and read it back.

    In append mode a period is written once the watermark has passed its end.
    The offsets and state live in the shared folder, so a restarted query
    goes on where it stopped.
    """
    spark = df.sparkSession
    query = (
        df.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)
