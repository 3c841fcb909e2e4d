"""Structured Streaming entry to staging: deliveries that arrive as files are typed as they land.

The batch pipeline has no streaming operators of its own; ``stage`` is stateless,
so it runs unchanged over a stream, and tables are written file by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..plans.staging import columns_of, stage


def staged_stream(spark: SparkSession, folder: str, model: str, config: Config = Config(), **options: str) -> DataFrame:
    """New delimited files of ``folder`` as a stream of typed rows of ``model``."""
    raw = T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(s for s, _, _ in columns_of(model))])
    reader = spark.readStream.schema(raw).option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return stage(reader.csv(folder), model, config)


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all files that are there once, exactly once per file, and stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
