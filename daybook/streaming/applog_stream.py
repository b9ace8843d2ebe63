"""Structured Streaming form of the app-log cleanse (Q-LOG).

The reference runs the cleanse as a daily batch; the same operator applies to a
stream of log files because it is stateless per record. Each micro-batch is handed to
the batch operator through ``foreachBatch`` (the dictionaries are static tables) and
written under ``batch_id=<n>`` with overwrite, so a replayed batch after a failure
replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.applog import cleanse_app_log


def start_applog_cleanse(spark: SparkSession, source_dir: str, geo_dict: DataFrame, idmap: DataFrame,
                         sink_dir: str, checkpoint_location: str, available_now: bool = False,
                         processing_time: str | None = None, max_files_per_trigger: int | None = None
                         ) -> StreamingQuery:
    """Start the streaming cleanse: text files in ``source_dir`` -> parquet under
    ``sink_dir``. ``checkpoint_location`` must be a shared, reliable folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = cleanse_app_log(batch, geo_dict, idmap)
        out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
