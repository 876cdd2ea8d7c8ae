"""Documents as they land: the vision path over a folder of raw responses, once through what is there."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans import vlm


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, hint: str | None = None) -> StreamingQuery:
    """Start a stream from JSON lines (doc_id, raw_text) in source to JSON lines in target; no stage needs state."""
    raw = spark.readStream.schema("doc_id string, raw_text string").json(source)
    done = vlm.run(raw, hint).select("doc_id", F.to_json("meta").alias("meta"), F.to_json("rows").alias("rows"), "validation", "parse_error")
    return done.writeStream.format("json").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
