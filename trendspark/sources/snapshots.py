"""Landed raw snapshots: JSON API envelopes and legacy CSV exports.

Landing layout: ``<base>/region=<m>/date=<yyyy-mm-dd>/hour=<hh>/<id>.json``,
append-only. Partition columns come from discovery, so a market or date
filter prunes directories before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField,
                               StructType)

from trendspark.operators import silver

_S = StringType()


def _struct(*names: str) -> StructType:
    return StructType([StructField(n, _S) for n in names])


ITEM_SCHEMA = StructType([
    StructField("id", _S),
    StructField("snippet", StructType([
        StructField("title", _S), StructField("channelTitle", _S), StructField("channelId", _S),
        StructField("categoryId", _S), StructField("publishedAt", _S),
        StructField("tags", ArrayType(_S)), StructField("description", _S),
        StructField("thumbnails", StructType([StructField("default", _struct("url"))])),
    ])),
    StructField("statistics", _struct("viewCount", "likeCount", "dislikeCount", "commentCount")),
    StructField("contentDetails", _struct("duration", "definition", "caption")),
])
ENVELOPE_SCHEMA = StructType([
    StructField("items", ArrayType(ITEM_SCHEMA)),
    StructField("_pipeline_metadata", StructType([
        StructField("ingestion_id", _S), StructField("region", _S),
        StructField("ingestion_timestamp", _S), StructField("source", _S),
        StructField("item_count", LongType()),
    ])),
])
CSV_COLUMNS = ("video_id", "trending_date", "title", "channel_title", "category_id",
               "publish_time", "tags", "views", "likes", "dislikes", "comment_count",
               "thumbnail_link", "comments_disabled", "ratings_disabled",
               "video_error_or_removed", "description")
CSV_SCHEMA = StructType([StructField(c, _S) for c in CSV_COLUMNS]
                        + [StructField("_corrupt_record", _S)])

# fixed values: how the exports quote, and how a record begins (an 11-character id, a YY.DD.MM date)
CSV_QUOTES = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_corrupt_record"}
RECORD_START = r"[^,\n]{11},\d{2}\.\d{2}\.\d{2},"

ORDER_COLUMNS = ("_hour", "_ingestion_timestamp", "_ingestion_id")
REGION_FROM_PATH = r"(?:^|/)region=([^/]*)"


def region_from_path(path: Column) -> Column:
    """Market code from a ``region=<m>`` path segment; ``unknown`` without one."""
    return F.coalesce(F.nullif(F.regexp_extract(path, REGION_FROM_PATH, 1), F.lit("")),
                      F.lit("unknown"))


def read_snapshot_envelopes(spark: SparkSession, base: str, markets=None,
                            dates=None) -> DataFrame:
    """One row per landed document, pruned to the given markets / dates."""
    df = (spark.read.schema(ENVELOPE_SCHEMA).option("multiLine", True)
          .option("basePath", base).json(base))
    if markets is not None:
        df = df.where(F.col("region").isin(list(markets)))
    if dates is not None:
        df = df.where(F.col("date").isin(list(dates)))
    return df


def flatten_items(envelopes: DataFrame) -> DataFrame:
    """``explode(items)`` to one row per video, keeping ingestion order columns."""
    tags = F.array_join(F.col("item.snippet.tags"), "|")
    return envelopes.select(
        F.explode("items").alias("item"), "region", "date",
        F.col("hour").cast("int").alias("_hour"),
        F.col("_pipeline_metadata.ingestion_timestamp").alias("_ingestion_timestamp"),
        F.col("_pipeline_metadata.ingestion_id").alias("_ingestion_id"),
    ).select(
        F.col("item.id").alias("id"),
        F.col("item.snippet").withField("tags", tags).alias("snippet"),
        F.col("item.statistics").alias("statistics"),
        F.col("item.contentDetails").alias("contentDetails"),
        "region", "date", *ORDER_COLUMNS,
    )


def api_to_silver(items: DataFrame, job_name: str = "silver",
                  processed_at: Column | None = None, keep_order: bool = False) -> DataFrame:
    """API items -> canonical -> cleansed -> newest copy per grain.

    The snapshot date is the ``date=`` partition, not the clock; the newest
    copy is chosen by landing hour, ingestion time and id (a total order), which
    ``keep_order`` leaves in the rows for a later merge.
    """
    canon = silver.to_canonical(items, snapshot_date_col=F.col("date").cast("date"),
                                keep=ORDER_COLUMNS)
    cleansed = silver.cleanse(canon, job_name, processed_at)
    newest = silver.deduplicate(cleansed, order=ORDER_COLUMNS)
    return newest if keep_order else newest.drop(*ORDER_COLUMNS)


def read_snapshots_csv(spark: SparkSession, path: str, recover: bool = False) -> tuple[DataFrame, DataFrame]:
    """Legacy CSV (embedded newlines, doubled quotes) -> (rows, quarantined rows).

    An unclosed quote swallows the following lines into ``description``; such
    rows are quarantined by the pattern "newline, then an 11-char id and a
    YY.DD.MM date", as are rows Spark flags as malformed. With ``recover`` the
    records in quarantined text are parsed again (``recover_swallowed``).
    """
    df = (spark.read.schema(CSV_SCHEMA)
          .options(header=True, multiLine=True, mode="PERMISSIVE", **CSV_QUOTES)
          .csv(path)
          .withColumn("region", region_from_path(F.col("_metadata.file_path"))))
    swallowed = F.coalesce(F.col("description").rlike(rf"\n{RECORD_START}"), F.lit(False))
    bad = swallowed | F.col("_corrupt_record").isNotNull()
    rows, quarantined = df.where(~bad).drop("_corrupt_record"), df.where(bad)
    if not recover:
        return rows, quarantined
    recovered, lost = recover_swallowed(quarantined)
    return rows.unionByName(recovered), lost


def parsed_records(df: DataFrame, text: Column) -> DataFrame:
    """The rows of ``df`` once for each piece of ``text`` that begins where a record does: ``_at`` (0: what stands before
    the first boundary, or begins the text), ``_piece``, ``_record`` (its columns) and ``_whole``.

    A piece is a whole record if it begins with an id and a date, closes every quote, fills all columns, and has numbers
    and flags where they belong; anything else is not guessed at.
    """
    pieces = df.select("*", F.posexplode(F.split(text, rf"\n(?={RECORD_START})")).alias("_at", "_piece"))
    pieces = pieces.withColumn("_piece", F.rtrim("_piece", F.lit("\r\n")))
    pieces = pieces.withColumn("_record", F.from_csv("_piece", CSV_SCHEMA.simpleString()[7:-1].replace(":", " "), CSV_QUOTES))
    record = F.col("_record")
    checks = [F.col("_piece").rlike(f"^{RECORD_START}"), F.regexp_count("_piece", F.lit('"')) % 2 == 0, record["_corrupt_record"].isNull()]
    checks += [record[c].try_cast("long").isNotNull() for c in ("views", "likes", "dislikes", "comment_count")]
    checks += [F.upper(record[c]).isin("TRUE", "FALSE") for c in ("comments_disabled", "ratings_disabled", "video_error_or_removed")]
    whole = checks[0]
    for check in checks[1:]:
        whole = whole & check
    return pieces.withColumn("_whole", F.coalesce(whole, F.lit(False)))


def recover_swallowed(quarantined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantined rows -> (records found whole in their text, what is left in quarantine).

    The text is the raw record where Spark kept it, else the description that swallowed the lines after it. Nothing is
    lost: the broken row stays, cut at the first boundary, and a piece that is no whole record stays as a row of its own
    with its text in ``_corrupt_record``.
    """
    raw = F.col("_corrupt_record").isNotNull()
    pieces = parsed_records(quarantined, F.coalesce("_corrupt_record", "description", F.lit("")))
    recovered = pieces.where("_whole").select(*[F.col(f"_record.{c}").alias(c) for c in CSV_COLUMNS], "region")
    first = F.col("_at") == 0
    before = {"description": F.split("description", rf"\n(?={RECORD_START})")[0]}
    columns = [F.when(first, before.get(c, F.col(c))).alias(c) for c in CSV_COLUMNS]
    lost = pieces.where("NOT _whole").select(*columns, F.when(raw | ~first, F.col("_piece")).alias("_corrupt_record"), "region")
    return recovered, lost


__all__ = ["read_snapshot_envelopes", "flatten_items", "api_to_silver", "read_snapshots_csv",
           "region_from_path", "ENVELOPE_SCHEMA", "CSV_SCHEMA", "BooleanType"]
