"""CSV sources whose types are found, and whose bad rows do not end a load.

A value fits some of the types below; a column has the first type that all its
values fit.  The types a value fits are the bits of a number, so a column's
types are the ``bit_and`` of its values': one aggregate over the whole file,
added up in the tasks before it is shuffled, and the masks of several files (or
loads) merge by the same rule.

A checked read casts every field to a schema and keeps the rows that fit.  The
others go to a table of rejects with their text and the reason.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.files import CSV_OPTIONS, header_columns

# Narrow to wide, and the text a value of the type has.  A whole number also fits
# double, a date also fits timestamp, and everything fits string.
_NUMBER = r"-?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
TYPES: list[tuple[T.DataType, str]] = [
    (T.BooleanType(), r"(?i)true|false"),
    (T.LongType(), r"-?[0-9]+"),
    (T.DoubleType(), _NUMBER),
    (T.DateType(), _DATE),
    (T.TimestampNTZType(), _DATE + r"([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?"),
]
ANY = (1 << len(TYPES)) - 1
REJECTS = "source string, row_text string, reason string"


def fitting(value: Column) -> Column:
    """The types a text fits, one bit each; null (which fits all) for a null or
    blank text."""
    text = F.trim(value)
    bits = [
        F.when(text.rlike(f"^({form})$") & text.try_cast(kind).isNotNull(), 1 << bit).otherwise(0)
        for bit, (kind, form) in enumerate(TYPES)
    ]
    return F.when(text != "", reduce(Column.bitwiseOR, bits))


def column_masks(rows: DataFrame) -> dict[str, int | None]:
    """Of each text column the types that all its values fit, None without any
    value.  One row comes back, whatever the size of the input."""
    names = rows.columns
    found = rows.agg(*(F.bit_and(fitting(rows[f"`{c}`"])).alias(str(i)) for i, c in enumerate(names))).first()
    return dict(zip(names, found))


def merged(*masks: dict[str, int | None]) -> dict[str, int | None]:
    """The masks of the rows of all of ``masks`` together, columns in order of
    first sight."""
    names = dict.fromkeys(name for m in masks for name in m)
    known = {name: [m[name] for m in masks if m.get(name) is not None] for name in names}
    return {name: reduce(int.__and__, values) if values else None for name, values in known.items()}


def schema_of(masks: dict[str, int | None]) -> T.StructType:
    """The narrowest type of each column; string where nothing narrower fits or
    there is no value."""
    narrowest = lambda m: next((kind for bit, (kind, _) in enumerate(TYPES) if m and m >> bit & 1), T.StringType())
    return T.StructType([T.StructField(name, narrowest(mask)) for name, mask in masks.items()])


def _texts(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], Column]:
    """All fields as text, their names, and the line where its number of fields
    is not the header's (null for every other line)."""
    header = header_columns(spark, path)
    broken = "broken_line"
    while broken in (name.lower() for name in header):
        broken += "_"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, broken]])
    # Without pruning: a line is split whole, so its fields are always counted.
    options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken, "columnPruning": "false"}
    read = spark.read.options(**options).schema(schema).csv(path)
    # Spark refuses to read broken lines without any field; this always holds.
    with_field = F.coalesce(F.length(read[f"`{header[0]}`"]), F.lit(0)) >= 0
    return read, header, F.when(with_field, read[f"`{broken}`"])


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """The types of a header CSV from all its rows (not from the first ones).
    Lines with too few or too many fields have no say.  A file without rows has
    only strings."""
    texts, header, line = _texts(spark, path)
    return schema_of(column_masks(texts.where(line.isNull()).select(*(F.col(f"`{c}`") for c in header))))


@dataclass(frozen=True)
class Checked:
    """What a checked read found: rows of the schema, and the others."""

    rows: DataFrame
    rejects: DataFrame


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> Checked:
    """A header CSV by column name, with the given or the inferred types.

    A row is rejected if it has too few or too many fields or a field that is
    not of its type; ``rejects`` holds its file, its text and every reason.
    Blank fields are null and fit every type, spaces around a number or a date
    are left out, repeated rows stay.  Columns beyond the schema are not
    checked; a column the file lacks is an error, as in ``read_csv_source``.
    """
    if schema is None:
        schema = infer_schema(spark, path)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts, header, line = _texts(spark, path)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")

    def typed(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        return text if isinstance(field.dataType, T.StringType) else F.trim(text).try_cast(field.dataType)

    def fault(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        said = F.concat(F.lit(f"{field.name}: '"), text, F.lit(f"' is not {field.dataType.simpleString()}"))
        return F.when((F.trim(text) != "") & typed(field).isNull(), said)

    faults = [fault(f) for f in schema if not isinstance(f.dataType, T.StringType)]
    reason = F.when(line.isNotNull(), "too few or too many fields").otherwise(F.concat_ws("; ", *faults))
    fields = F.struct(*(F.col(f"`{c}`") for c in header))
    rejects = texts.where(reason != "").select(
        F.col("_metadata.file_path").alias("source"),
        F.coalesce(line, F.to_csv(fields, {"escape": '"'})).alias("row_text"),
        reason.alias("reason"),
    )
    return Checked(texts.where(reason == "").select(*(typed(f).alias(f.name) for f in schema)), rejects)
