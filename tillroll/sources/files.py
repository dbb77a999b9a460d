"""File sources and sinks.

Raw CSVs are read here with an explicit schema (no inference pass over the
data; :mod:`tillroll.sources.checked` finds types and survives bad rows); blank fields arrive as nulls, so nothing has to parse ``''``.
Columns are found by their header name, quotes inside a quoted field are
doubled (RFC 4180), and a field that does not parse as its type fails the
read instead of becoming a null that a later filter would drop.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV source, from its header line alone."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path).columns


def read_csv_source(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV, columns by name in any order.  Columns beyond the schema
    are left out; a missing one is an error (source drift, Q8)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = header_columns(spark, path)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    in_file_order = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in header])
    return spark.read.options(**CSV_OPTIONS).schema(in_file_order).csv(path).select(*schema.names)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small hand-maintained seed CSV (e.g. the branch list)."""
    return read_csv_source(spark, path, schema)


def write_result_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV result.  ``single_file`` is for results with a known
    small bound (a top-N list, one row per threshold); anything else is
    written by all its partitions.  Quotes are doubled, as the reader expects."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a result back; a missing result is an empty frame."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_csv_source(spark, path, schema)


def write_table(df: DataFrame, path: str) -> None:
    """(re)write a lone Parquet table at ``path``.

    The rows go to a hidden folder beside it, which takes the table's place
    once it is complete: a write that fails leaves the table as it was.  The
    old folder is moved aside first, so between the two renames there is no
    table; tables that are read while they are rebuilt belong in published
    versions (:mod:`tillroll.sources.versions`).
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    # A name with "=" would be listed as a partition, hidden or not.
    beside = f"{parent}/_{{}}-{uuid.uuid4().hex}-{name.replace('=', '-')}"
    df.write.parquet(beside.format("staging"))
    fs, target = _file_system(df.sparkSession, path)
    _, complete = _file_system(df.sparkSession, beside.format("staging"))
    _, old = _file_system(df.sparkSession, beside.format("old"))
    replaced = fs.exists(target) and fs.rename(target, old)
    if not fs.rename(complete, target):
        raise OSError(f"the new rows of {path} could not be renamed to it")
    if replaced:
        fs.delete(old, True)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system that Spark itself would use for the path."""
    fs, hpath = _file_system(spark, path)
    return fs.exists(hpath)


def csv_sources(spark: SparkSession, raw_dir: str, seed_path: str, bad_rows: str = "fail"):
    """S1 + S4: the six raw CSV sources and the branch seed as ``RawSources``.

    ``bad_rows`` says what a row does that does not fit its types: ``"fail"``
    ends the read, ``"reject"`` sets the row aside in ``RawSources.rejects``.
    The seed is kept by hand and always has to be right.
    """
    from tillroll import schemas as S
    from tillroll.sources.adapter import RawSources
    from tillroll.sources.checked import read_csv_checked

    if bad_rows not in ("fail", "reject"):
        raise ValueError("bad_rows must be 'fail' or 'reject'")
    rejects = []

    def rd(name: str, schema: T.StructType) -> DataFrame:
        path = f"{raw_dir.rstrip('/')}/{name}.csv"
        if bad_rows == "fail":
            return read_csv_source(spark, path, schema)
        checked = read_csv_checked(spark, path, schema)
        rejects.append(checked.rejects)
        return checked.rows

    sources = RawSources(
        orders=rd("orders", S.BRONZE_ORDERS),
        order_products_prior=rd("order_products__prior", S.BRONZE_ORDER_PRODUCTS),
        order_products_train=rd("order_products__train", S.BRONZE_ORDER_PRODUCTS),
        products=rd("products", S.BRONZE_PRODUCTS),
        aisles=rd("aisles", S.BRONZE_AISLES),
        departments=rd("departments", S.BRONZE_DEPARTMENTS),
        branches=read_seed(spark, seed_path, S.BRANCH_SEED),
    )
    return replace(sources, rejects=reduce(DataFrame.unionByName, rejects)) if rejects else sources
