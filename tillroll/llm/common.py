"""Helpers shared by the corpus operators: table access, Arrow batches,
reliable checkpoints and bounded samples."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

# Rows handed to Python at once.  A batch holds whole texts, so it is kept
# small: a few hundred long documents still fit beside the executor's heap.
ARROW_ROWS = 256
ARROW_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): a null text is empty, every other column is left
    out, so that an input column named like an output cannot clash."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def _row_numbers(spark: SparkSession) -> Column:
    """Numbers by file split and place in it.  Spark sizes splits by the cores it
    sees when a scan is planned; pinning that number keeps the splits, and so
    the numbers, the same in every pass even as executors come and go."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def numbered(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, text).  Numbers follow the stored files, so they are the
    same in every pass and in a retried task: ``docs`` must be a stored table,
    not the result of a shuffle."""
    return id_text(docs).withColumn("row_id", _row_numbers(docs.sparkSession))


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows numbered in ``dropped`` (row_id)."""
    # Names that no input column can have by chance.
    row, gone = (f"{name}_{uuid.uuid4().hex}" for name in ("row", "gone"))
    numbered_rows = docs.withColumn(row, _row_numbers(docs.sparkSession))
    return numbered_rows.join(dropped.select(F.col("row_id").alias(gone)), F.col(row) == F.col(gone), "left_anti").drop(row)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry whole texts to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage into ``spark.checkpoint.dir`` (shared storage)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def held_out(id_col: Column) -> Column:
    """The fold that no model may learn labels from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, max_chars: int):
    """A bounded sample of labelled rows outside the held-out fold, as
    ``[(text, label)]`` on the driver, whole texts.

    At most ``per_class`` rows of each class, chosen by the hash of their id
    (the same rows whatever the partitioning).  They are taken in that order as
    long as a class stays within ``max_chars`` characters; a row that would go
    over is left out, so the bound costs rows and never the rest of a text.
    Rows without a label or a text are left out; of several labels for an id
    the largest counts, of several texts the least.
    """
    truth = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(target))
    chosen = None
    for value in (0, 1):
        part = truth.where(F.col("label") == value).withColumn("place", order).orderBy("place", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = id_text(docs).where(F.length("text") > 0)
    # At most 2 * per_class ids: small enough to broadcast by construction.
    sizes = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label", "place")
        .agg(F.max(F.length("text")).alias("chars"))
        .collect()
    )
    left, ids = {0: max_chars, 1: max_chars}, []
    for r in sorted(sizes, key=lambda r: (r.place, r.doc_id)):
        if r.chars <= left[r.label]:
            left[r.label] -= r.chars
            ids.append((r.doc_id, r.label))
    taken = docs.sparkSession.createDataFrame(ids, "doc_id long, label int")
    rows = texts.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    return [(r.text, r.label) for r in sorted(rows, key=lambda r: r.doc_id)]


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
        )


class Scratch:
    """Intermediate tables in ``spark.checkpoint.dir``.

    A written table is a cut in the lineage that survives lost executors and,
    unlike a checkpoint, is compressed and can be removed as soon as the next
    pass is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more, and let Spark's cleaner
        drop the shuffle files of the frames that made them."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        jvm.System.gc()
