"""Incremental Silver intake with Structured Streaming (the job bookmark).

New landed files are picked up by the file source; the checkpoint records
which files were processed, so a rerun over the same landing folder adds
nothing. Each micro-batch is cleansed and de-duplicated, then merged with the
existing rows of the Silver partitions it touches; the newest copy of a key by
landing hour, ingestion time and id stays, wherever it comes from, so files that
arrive late or out of order give what one batch over all files gives. Silver
therefore keeps those order columns. Partitions match null-safely (a row without a
date has one too).

The parsed batch, and the merged frame before the overwrite, are checkpointed
(reliably, under the cluster's checkpoint folder): the JSON is parsed once, and the
write no longer reads the files it replaces. Replaying a batch yields the same
partitions, and a ledger beside Silver names the batches that are written, so each
counts once. Documents that cannot be read go to dead letters, if a folder is given.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from trendspark import publish
from trendspark.operators.silver import deduplicate
from trendspark.session import cut, prepare, stream_checkpoint
from trendspark.sinks import write_table
from trendspark.sources import dead_letters, snapshots

PARTITIONS = ("region", "trending_date_parsed")
LANDING_SCHEMA = StructType(dead_letters.CAPTURING_SCHEMA.fields + [
    StructField("region", StringType()), StructField("date", DateType()),
    StructField("hour", IntegerType())])
#: Most files of a micro-batch; a backlog is drained in several.
MAX_FILES = 10_000


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def merge_batch(batch: DataFrame, silver_path: str, name: str | None = None, dead_letters_path: str | None = None) -> None:
    """Merge a micro-batch into Silver. With a ``name`` the ledger beside Silver records the batch once it is written, and
    a batch that the ledger has is left alone; one that was lost between the write and its record is merged again, with
    the same result."""
    spark = batch.sparkSession
    ledger = publish.Store(spark, silver_path.rstrip("/") + "_ledger")
    if name is not None and ledger.read(name) is not None:
        return
    if dead_letters_path is not None:
        batch, dead = dead_letters.split(cut(batch))
        if not dead.isEmpty():
            dead_letters.write_dead_letters(dead, dead_letters_path, name or "unnamed")
    rows = cut(snapshots.api_to_silver(snapshots.flatten_items(batch), "incremental_silver", keep_order=True))
    if not rows.isEmpty():
        if _exists(spark, silver_path):
            existing = spark.read.schema(rows.schema).parquet(silver_path)
            touched = rows.select(*[F.col(c).alias(f"_{c}") for c in PARTITIONS]).distinct()
            same = F.lit(True)
            for c in PARTITIONS:
                same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
            rows = rows.unionByName(existing.join(touched, same, "left_semi"))
            rows = deduplicate(rows, order=snapshots.ORDER_COLUMNS)
        write_table(cut(rows), silver_path, PARTITIONS)
    if name is not None:
        ledger.replace(name, "written")


def merged_batches(spark: SparkSession, silver_path: str) -> list[str]:
    """The batches that the ledger has."""
    return publish.Store(spark, silver_path.rstrip("/") + "_ledger").folders("")


def start_incremental_silver(spark: SparkSession, landing: str, silver_path: str,
                             checkpoint: str | None = None, markets=None,
                             available_now: bool = True, max_files: int = MAX_FILES,
                             dead_letters_path: str | None = None):
    """Start the stream; with ``available_now`` it drains the backlog, at most ``max_files`` at a time, and stops."""
    prepare(spark)
    if checkpoint is None:
        name = "incremental_silver_" + re.sub(r"[^A-Za-z0-9]+", "_", silver_path).strip("_")
        checkpoint = stream_checkpoint(spark, name)
    stream = (spark.readStream.schema(LANDING_SCHEMA)
              .options(multiLine=True, basePath=landing, maxFilesPerTrigger=max_files,
                       columnNameOfCorruptRecord=dead_letters.CORRUPT)
              .json(landing).withColumn("path", F.col("_metadata.file_path")))
    if markets is not None:
        stream = stream.where(F.col("region").isin(list(markets)))

    def merge(batch: DataFrame, epoch: int) -> None:
        # a stream keeps its id as long as its checkpoint, so a batch has one name however often it is run
        stream_id = json.loads(publish.Store(spark, checkpoint).read("metadata"))["id"]
        merge_batch(batch, silver_path, f"{stream_id}-{epoch}", dead_letters_path)

    writer = (stream.writeStream.foreachBatch(merge)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_incremental_silver(spark: SparkSession, landing: str, silver_path: str,
                           checkpoint: str | None = None, markets=None, max_files: int = MAX_FILES,
                           dead_letters_path: str | None = None) -> DataFrame:
    query = start_incremental_silver(spark, landing, silver_path, checkpoint, markets,
                                     max_files=max_files, dead_letters_path=dead_letters_path)
    query.awaitTermination()
    return spark.read.parquet(silver_path)
