"""Daily inference as an incremental stream: every load date that arrives is predicted exactly once.

The cascade keeps no state, so the batch operators are used as they are. The stream only remembers, in its
checkpoint, which files it has seen; run it on a schedule with ``available_now`` or leave it running.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfspark import names as N
from shelfspark.functions.scalar import without_nan
from shelfspark.operators.cascade import cascade_predict
from shelfspark.operators.scorers import Scorer, score_cascade


def stream_features(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Feature rows of new files below ``base``; the schema names the partition columns as strings too."""
    return without_nan(spark.readStream.schema(schema).parquet(base))


def predict_stream(
    features: DataFrame, models: Mapping[str, Scorer], t1: float, t2: float, columns: Sequence[str]
) -> DataFrame:
    predicted = cascade_predict(score_cascade(features, models, t1, t2), t1, t2)
    return predicted.select(*columns, N.LOCATION_GROUP, N.LOAD_DATE)


def write_predictions(
    predicted: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append predictions by load date and group. The checkpoint must be in a folder all executors share."""
    writer = (
        predicted.writeStream.format("parquet")
        .partitionBy(N.LOAD_DATE, N.LOCATION_GROUP)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start(out)
