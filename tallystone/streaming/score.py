"""Fitted preparation and models applied to streams. Both are stateless projections."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallystone.plans.prepare import FittedPreparation
from tallystone.session import scratch_path


def read_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", fmt: str = "parquet") -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).format(fmt).load(folder)


def prepare_stream(stream: DataFrame, fitted: FittedPreparation, with_target: bool = True) -> DataFrame:
    """Encode and scale unseen rows with the fitted parameters."""
    if fitted.bounds is not None and fitted.settings.outlier_action == "transform":
        raise ValueError("the log-transform outlier action looks at a whole column, which a stream has not")
    return fitted.apply(stream, with_target)


def score_stream(prepared: DataFrame, model: Model) -> DataFrame:
    """Add probability and prediction to prepared rows."""
    return model.transform(prepared)


def write_stream(stream: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Process everything available, exactly once per input file, and stop.

    Progress is kept in ``checkpoint``; by default a new folder under the shared one.
    """
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream")
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
