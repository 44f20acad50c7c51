"""Scoring of arriving requests.

The rules and the model are per-row expressions, so the stream runs in append mode without state:
no watermark is needed and a restarted query continues from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfcast.functions.numeric import fixed
from shelfcast.operators.models import Model, predict_demand, validate_requests
from shelfcast.operators.panel import CALENDAR_FEATURES, FEATURE_COLUMNS

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        *[
            T.StructField(
                name, T.IntegerType() if name in CALENDAR_FEATURES else T.DoubleType()
            )
            for name in FEATURE_COLUMNS
        ],
    ]
)


def read_requests(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Requests from parquet files as they arrive in ``folder``."""
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def score_requests_stream(
    requests: DataFrame, model: Model, accepted_path: str, rejected_path: str, checkpoint: str,
    every: str | None = None,
) -> list[StreamingQuery]:
    """Start one query for accepted requests with their scores and one for rejected requests.

    Both are exactly-once file sinks with their own checkpoint. They run on, in the interval ``every``,
    such as "10 seconds"; without it they take what has arrived and end.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    validated = validate_requests(requests)
    fine = F.size("failed_rules") == 0
    scored = predict_demand(validated.where(fine), model).select(
        "request_id", "product_id", "category", fixed("prediction", 4).alias("predicted_demand")
    )
    refused = validated.where(~fine).select("request_id", "product_id", "category", "failed_rules")
    return [
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**trigger)
        .start(path)
        for name, df, path in (
            ("accepted", scored, accepted_path), ("rejected", refused, rejected_path)
        )
    ]
