"""Category reference documents -> flat per-market lookup rows.

A document is ``{kind, etag, items: [{kind, etag, id, snippet: {...}}]}``;
each item becomes a row, nested fields are flattened with ``_`` (a document
without ``items`` is itself one row). Duplicated ids inside one file keep the
last one in file order. The market comes from the ``region=`` path segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import logging

from trendspark.sources.snapshots import region_from_path

REQUIRED = ("id", "snippet_title")
log = logging.getLogger(__name__)


def _flatten_field(path: str, dtype, name: str) -> list[Column]:
    if isinstance(dtype, StructType):
        cols = []
        for f in dtype.fields:
            cols.extend(_flatten_field(f"{path}.{f.name}", f.dataType, f"{name}_{f.name}"))
        return cols
    return [F.col(path).alias(name)]


def _documents(spark: SparkSession, path: str, date: str | None) -> DataFrame:
    """Documents under ``path``, of one date if given. Only that date's folders are listed and read, so the
    documents of other dates neither cost a scan nor change the types found."""
    reader = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    folders = f"{path.rstrip('/')}/region=*/date={date}"
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folders)
    if date is not None and glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob):
        raw = reader.option("basePath", path).json(folders)
    else:
        raw = reader.json(path)
    raw = raw.withColumn("_source_file", F.col("_metadata.file_path"))
    if date is not None and "date" in raw.columns:
        raw = raw.where(F.col("date").cast("string") == date)
    return raw


def read_reference(spark: SparkSession, path: str, date: str | None = None,
                   ingested_at: Column | None = None) -> DataFrame:
    """Flatten every reference document under ``path`` (optionally one date)."""
    raw = _documents(spark, path, date)
    flat = flatten_reference(raw, ingested_at)
    missing = [c for c in REQUIRED if c not in flat.columns]
    if missing:  # kept as a warning: the lookup falls back to "Unknown Category"
        log.warning("reference documents lack expected columns %s", missing)
    return flat


def flatten_reference(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    if "_corrupt_record" in raw.columns:
        raw = raw.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    top = [c for c in raw.columns if c not in ("items", "_source_file", "region", "date")]
    if "items" in raw.columns:
        with_items = raw.where(F.col("items").isNotNull()).select(
            "_source_file", F.posexplode("items").alias("_pos", "item"))
        item_type = raw.schema["items"].dataType.elementType
        rows = with_items.select(
            "_source_file", "_pos",
            *[c for f in item_type.fields
              for c in _flatten_field(f"item.{f.name}", f.dataType, f.name)])
        bare = raw.where(F.col("items").isNull())
    else:
        rows, bare = None, raw
    bare_rows = bare.select(
        "_source_file", F.lit(0).alias("_pos"),
        *[c for name in top for c in _flatten_field(name, raw.schema[name].dataType, name)])
    flat = bare_rows if rows is None else rows.unionByName(bare_rows, allowMissingColumns=True)
    if "id" in flat.columns:
        payload = [c for c in flat.columns if c not in ("_source_file", "id")]
        flat = (flat.groupBy("_source_file", "id")
                .agg(F.max_by(F.struct(*payload), F.col("_pos")).alias("_r"))
                .select("_source_file", "id", "_r.*"))
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return flat.drop("_pos").withColumns({
        "_ingestion_timestamp": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "region": region_from_path(F.col("_source_file")),
    })


def reference_outcome(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Per-file outcome for one date: category rows and whether the file is usable.

    Raises when the date has no file or when no file is usable (unreadable
    or without any category row).
    """
    raw = _documents(spark, path, date)
    corrupt = (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns
               else F.lit(False))
    # a document without ``items`` is itself one row
    n_items = (F.when(F.col("items").isNull(), F.lit(1)).otherwise(F.size("items"))
               if "items" in raw.columns else F.lit(1))
    per_file = raw.groupBy("_source_file").agg(
        F.max(corrupt.cast("int")).alias("_bad"),
        F.sum(F.greatest(n_items, F.lit(0))).alias("rows"))
    # a readable document without any category row is a failed file too
    outcome = per_file.select("_source_file", region_from_path(F.col("_source_file")).alias("region"),
                              ((F.col("_bad") == 0) & (F.col("rows") > 0)).alias("ok"), "rows")
    stats = outcome.agg(F.count(F.lit(1)).alias("files"), F.count_if("ok").alias("good")).first()
    if stats["files"] == 0:
        raise RuntimeError(f"No reference files found for date={date}")
    if stats["good"] == 0:
        raise RuntimeError(f"All {stats['files']} reference file(s) failed to process")
    return outcome
