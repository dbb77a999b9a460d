"""S5 as a file stream: new order files in a landing folder are appended to
``bronze_orders`` with the same rules as the batch load (ids above the last
successful watermark, not already held).

* The source is ``readStream.csv`` with the fixed schema; the stream's
  checkpoint (under the warehouse root, i.e. shared storage) records which
  files were consumed, so each file is processed once even across restarts.
* ``foreachBatch`` publishes each micro-batch as its own load
  ``stream-<query id>-<batch id>``: a batch replayed after a failure replaces
  that load, so the sink is idempotent (exactly-once output).
* Every batch writes one run-log row under its own run id (a replay replaces
  it), so batch and stream loads share one watermark.
* ``trigger(availableNow=True)`` drains what is there and stops (a scheduled
  incremental job); ``processingTime`` keeps it running.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas as S
from tillroll.plans.etl import Draft, WarehousePaths, current_watermark, published, read_bronze_orders, write_load
from tillroll.sources import incremental as inc
from tillroll.sources.files import CSV_OPTIONS
from tillroll.sources.runlog import append_log, log_row

STREAM_STAGE = "bronze_stream"


def _load_batch(spark: SparkSession, paths: WarehousePaths, query_id: str):
    def handle(batch: DataFrame, batch_id: int) -> None:
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        run_id = f"stream-{query_id}-{batch_id}"
        # Compare with the other loads only, in the log as in the table: a
        # replayed batch must rewrite the rows its first attempt already put
        # in its own folder, even if that attempt got as far as its log row.
        watermark = current_watermark(spark, paths, exclude_run=run_id)

        def load(draft: Draft) -> None:
            target = read_bronze_orders(spark, draft, exclude_load=run_id)
            write_load(inc.incremental_rows(batch, target, watermark), draft)

        published(load, spark, paths, run_id)
        rows_loaded, new_watermark = inc.tail_counters(read_bronze_orders(spark, paths), watermark)
        append_log(
            log_row(spark, run_id, STREAM_STAGE, "SUCCESS", rows_loaded, new_watermark, "OK", started_at=started),
            paths.log,
            run_id,
        )

    return handle


def start_orders_stream(
    spark: SparkSession,
    landing_dir: str,
    paths: WarehousePaths,
    query_id: str = "orders",
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the landing-folder -> bronze_orders stream and return the query."""
    # A file whose header is not the schema's fails the batch (no reading by position).
    reader = spark.readStream.options(**CSV_OPTIONS).option("enforceSchema", "false").schema(S.BRONZE_ORDERS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.csv(landing_dir)
    writer = (
        source.writeStream.foreachBatch(_load_batch(spark, paths, query_id))
        .option("checkpointLocation", paths.table(f"_checkpoints/{query_id}"))
        .queryName(f"bronze_orders_{query_id}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
