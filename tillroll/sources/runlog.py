"""The append-only run log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import ETL_LOG

# Fixed value: failure messages are cut to this many characters.
MESSAGE_LIMIT = 500


def new_run_id() -> str:
    """Drawn once on the driver, so every row of a run shares it (a
    ``uuid()`` column would be re-drawn on recomputation)."""
    return str(uuid.uuid4())


def log_row(
    spark: SparkSession,
    run_id: str,
    stage: str,
    status: str,
    rows_loaded: int,
    watermark_order_id: int,
    message: str,
    started_at: dt.datetime | None = None,
    finished_at: dt.datetime | None = None,
) -> DataFrame:
    """One run-log row; messages are cut to 500 characters.  The
    real start time is recorded when given."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [
            (
                run_id,
                stage,
                started_at or now,
                finished_at or now,
                status,
                int(rows_loaded),
                int(watermark_order_id),
                (message or "")[:MESSAGE_LIMIT],
            )
        ],
        ETL_LOG,
    )


def append_log(row: DataFrame, log_path: str, run_id: str) -> None:
    """Append a run's row to the Parquet run log.  Each run has a folder of
    its own, so a run that is repeated replaces its row instead of adding one."""
    row.write.mode("overwrite").parquet(f"{log_path}/run={run_id}")


def read_log(spark: SparkSession, log_path: str, exclude_run: str | None = None) -> DataFrame:
    """All rows of the log; ``exclude_run`` leaves out one run's."""
    from tillroll.sources.files import _exists

    if not _exists(spark, log_path):
        return spark.createDataFrame([], ETL_LOG)
    log = spark.read.schema(ETL_LOG).option("recursiveFileLookup", "true").parquet(log_path)
    return log if exclude_run is None else log.where(F.col("run_id") != exclude_run)
