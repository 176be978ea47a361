"""A stream of attempts (an extension: logged attempts that go on arriving).

The state of a request is a small aggregate, so the stream needs no Python: counts by status and the first valid
attempt by watermarked windows of arrival, and a complete view that equals the batch result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evspark.runtime import checkpoint_dir


def _status(valid: Column) -> Column:
    kind = F.regexp_replace(F.lower(F.trim("kind")), r"[\W_]+", "_")
    return F.when(kind == "technical_error", "TECHNICAL_FAILURE").when((kind == "response") & valid, "VALID").when(kind == "response", "INVALID_RESPONSE")


def running_attempts(stream: DataFrame, valid: Column) -> DataFrame:
    """(request_id, attempts, technical_failures, accepted), for output mode complete or update."""
    s = stream.withColumn("status", _status(valid))
    return s.groupBy("request_id").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == "TECHNICAL_FAILURE").alias("technical_failures"),
        F.min(F.when(F.col("status") == "VALID", F.col("attempt"))).alias("accepted"),
    )


def arrivals(stream: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, status, n) by window of arrival; second rows of an attempt inside the watermark count once."""
    s = stream.withColumn("received_at", F.col("received_at").cast("timestamp")).withWatermark("received_at", late)
    s = s.dropDuplicatesWithinWatermark(["request_id", "attempt"]).withColumn("status", _status(F.coalesce("raw_text", F.lit("")) != ""))
    return s.groupBy(F.window("received_at", every), "status").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "status", "n")


def run_to_end(result: DataFrame, mode: str) -> DataFrame:
    """Drive a bounded stream to its end and read what it wrote.

    State and results lie in the checkpoint folder that all executors share; nothing passes through the driver. In
    mode complete each batch writes the whole result, of which the last counts; in mode append each adds its rows.
    """
    spark = result.sparkSession
    where = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{where}/rows")

    query = result.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{where}/rows")
