"""Tables whose schema grows: a recorded schema, reconciled with every batch before anything is written.

Columns that a batch adds are null in the rows before; columns that it lacks are null in its rows; a type that widens
without loss (byte, short, int, long; float, double; int to double; decimals that keep every digit) is read as the wider
one from old files too. Any other change of type is a ``SchemaConflict`` that names the columns, raised before a file is
touched. Names are compared as Spark does, without case, and keep the table's spelling; nested types must be equal.

The schema lies in the small file ``_schema`` of the table's folder. It is replaced before the data is written: the
wider schema reads all old files, so a job that fails between the two leaves the table whole.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType, StructField, StructType,
)

from trendspark.publish import Store
from trendspark.sinks import write_table

RECORD = "_schema"
_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


class SchemaConflict(ValueError):
    """Columns whose type in a batch cannot be reconciled with the table's."""

    def __init__(self, changed: Sequence[tuple[str, str, str]]):
        self.columns = [name for name, _, _ in changed]
        super().__init__("; ".join(f"column {name}: the table has {old}, the batch {new}" for name, old, new in changed))


def _holds(wide: DataType, narrow: DataType) -> bool:
    """Whether every value of ``narrow`` is one of ``wide``."""
    if wide == narrow or isinstance(narrow, NullType):
        return True
    if wide in _WHOLE and narrow in _WHOLE:
        return _WHOLE.index(narrow) <= _WHOLE.index(wide)
    if isinstance(wide, DoubleType):
        return isinstance(narrow, FloatType) or narrow in _WHOLE[:3]
    if isinstance(wide, DecimalType):
        if isinstance(narrow, DecimalType):
            return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
        return wide.precision - wide.scale >= _DIGITS.get(narrow, 99)
    return False


def reconcile(table: StructType, batch: StructType) -> StructType:
    """The schema that holds both: the table's columns in their order, then the new ones."""
    new = {f.name.lower(): f for f in batch.fields}
    merged, changed = [], []
    for field in table.fields:
        other = new.pop(field.name.lower(), field).dataType
        if not _holds(field.dataType, other) and not _holds(other, field.dataType):
            changed.append((field.name, field.dataType.simpleString(), other.simpleString()))
        merged.append(StructField(field.name, field.dataType if _holds(field.dataType, other) else other, True))
    if changed:
        raise SchemaConflict(changed)
    added = [StructField(f.name, f.dataType, True) for f in new.values() if not isinstance(f.dataType, NullType)]
    return StructType(merged + added)


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema on record; for a table written without one, that of all its files; None without a table."""
    store = Store(spark, path)
    if text := store.read(RECORD):
        return StructType.fromJson(json.loads(text))
    if any(not name.startswith(("_", ".")) for name in store.folders("")):
        return spark.read.option("mergeSchema", True).parquet(path).schema
    return None


def write_evolving(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> StructType:
    """Overwrite the partitions present in ``df``, in a schema that holds the table's and the batch's; returns it."""
    before = recorded_schema(df.sparkSession, path)
    schema = reconcile(before if before is not None else StructType(), df.schema)
    own = {c.lower(): c for c in df.columns}
    columns = [(F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    Store(df.sparkSession, path).replace(RECORD, schema.json())
    write_table(df.select(*columns), path, partition_cols)
    return schema


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """The table in its schema on record."""
    schema = recorded_schema(spark, path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
