"""Silver layer: canonical projection, cleansing, derived rates, de-duplication.

Input is a raw snapshot frame (API JSON flattened, legacy CSV, or a bridge);
output is one row per (video_id, region, trending_date_parsed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.functions.columns import (duration_seconds, half_up_quotient, ratio, scaled,
                                          snapshot_date)

SILVER_KEY = ("video_id", "region", "trending_date_parsed")
COUNTERS = ("views", "likes", "dislikes", "comment_count")

CANONICAL = (
    ("video_id", "string"), ("trending_date", "string"), ("title", "string"),
    ("channel_title", "string"), ("channel_id", "string"), ("category_id", "long"),
    ("publish_time", "string"), ("tags", "string"), ("views", "long"), ("likes", "long"),
    ("dislikes", "long"), ("comment_count", "long"), ("thumbnail_link", "string"),
    ("comments_disabled", "boolean"), ("ratings_disabled", "boolean"),
    ("video_error_or_removed", "boolean"), ("description", "string"),
    ("duration", "string"), ("definition", "string"), ("caption", "string"),
    ("region", "string"),
)

# API field paths (dotted) feeding each canonical column
API_FIELDS = {
    "title": "snippet.title", "channel_title": "snippet.channelTitle",
    "channel_id": "snippet.channelId", "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt", "tags": "snippet.tags",
    "views": "statistics.viewCount", "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount", "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description", "duration": "contentDetails.duration",
    "definition": "contentDetails.definition", "caption": "contentDetails.caption",
}


def _field(df: DataFrame, dotted: str) -> Column | None:
    """A field given as a flat ``a.b`` / ``a__b`` column or a nested struct path."""
    cols = set(df.columns)
    if dotted in cols:
        return F.col(f"`{dotted}`")
    flat = dotted.replace(".", "__")
    if flat in cols:
        return F.col(flat)
    head, *rest = dotted.split(".")
    if head in cols and rest:
        dtype = df.schema[head].dataType
        for name in rest:
            names = getattr(dtype, "names", None) or []
            if name not in names:
                return None
            dtype = dtype[name].dataType
        return F.col(dotted)
    return None


def _typed(col: Column | None, dtype: str) -> Column:
    if col is None:
        return F.lit(None).cast(dtype)
    return col.try_cast(dtype)


def is_api_layout(df: DataFrame) -> bool:
    return _field(df, "snippet.title") is not None


def to_canonical(df: DataFrame, snapshot_date_col: Column | None = None,
                 keep=()) -> DataFrame:
    """Project either raw layout onto the 21 canonical columns.

    API rows take their snapshot date from ``snapshot_date_col`` (the ``date=``
    partition of the landing path), never from the wall clock. Text counters
    are converted with ``try_cast``: junk becomes NULL instead of failing.
    """
    if is_api_layout(df):
        exprs = []
        for name, dtype in CANONICAL:
            if name == "video_id":
                col = F.col("id").cast("string")
            elif name == "trending_date":
                col = (F.date_format(snapshot_date_col, "yyyy-MM-dd")
                       if snapshot_date_col is not None else F.lit(None).cast("string"))
            elif name == "dislikes":
                col = F.coalesce(_typed(_field(df, API_FIELDS[name]), "long"), F.lit(0).cast("long"))
            elif name in ("comments_disabled", "ratings_disabled", "video_error_or_removed"):
                col = F.lit(False)
            elif name == "region":
                col = F.col("region").cast("string")
            else:
                col = _typed(_field(df, API_FIELDS[name]), dtype)
            exprs.append(col.alias(name))
        return df.select(*exprs, *keep)
    cols = set(df.columns)
    return df.select(*[
        (_typed(F.col(name), dtype) if name in cols else F.lit(None).cast(dtype)).alias(name)
        for name, dtype in CANONICAL
    ], *keep)


def add_rate_metrics(df: DataFrame) -> DataFrame:
    """like_rate / comment_rate as fractions (6 places); 0.0 without views."""
    return df.withColumns({
        "like_rate": ratio("likes", "views", 6),
        "comment_rate": ratio("comment_count", "views", 6),
    })


def add_duration_seconds(df: DataFrame) -> DataFrame:
    if "duration" not in df.columns:
        return df.withColumn("duration_seconds", F.lit(None).cast("int"))
    return df.withColumn("duration_seconds", duration_seconds("duration"))


def add_velocity_context(df: DataFrame) -> DataFrame:
    """Hours from publish to the snapshot's UTC midnight and views per hour.

    The snapshot date (not the job's clock) is the observation instant, so a
    rerun gives the same values. The age can be negative; views per hour
    floors it at one hour. Unparseable or missing inputs give NULL.
    """
    if "publish_time" not in df.columns or "trending_date_parsed" not in df.columns:
        return df.withColumns({"video_age_hours": F.lit(None).cast("double"),
                               "views_per_hour": F.lit(None).cast("double")})
    # age in hundredths of an hour, exact: seconds * 100 / 3600, HALF_UP
    seconds = ("unix_timestamp(CAST(trending_date_parsed AS TIMESTAMP)) "
               "- unix_timestamp(try_to_timestamp(publish_time))")
    df = df.withColumn("_age_units", F.expr(
        f"CAST({half_up_quotient(seconds, '3600', 100)} AS BIGINT)"))
    return df.withColumns({
        "video_age_hours": F.col("_age_units") / 100.0,
        # views / max(age, 1 h) at 2 places = views * 10^4 / max(age units, 100)
        "views_per_hour": F.expr(
            "CASE WHEN _age_units IS NOT NULL THEN "
            f"{scaled('views', 'greatest(_age_units, 100)', 2, times=100)} END"),
    }).drop("_age_units")


def cleanse(df: DataFrame, job_name: str = "silver", processed_at: Column | None = None) -> DataFrame:
    """Drop keyless rows, normalise region and date, fill counters, derive rates."""
    df = (
        df.where(F.col("video_id").isNotNull())
        .withColumn("region", F.lower(F.trim(F.col("region"))))
        .withColumn("trending_date_parsed", snapshot_date("trending_date"))
        .withColumns({k: F.coalesce(F.col(k), F.lit(0).cast("long")) for k in COUNTERS})
    )
    df = df.withColumns({
        "like_ratio": ratio("likes", "views", 4, times=100),
        "engagement_rate": ratio(("likes", "dislikes", "comment_count"), "views", 4, times=100),
    })
    df = add_velocity_context(add_duration_seconds(add_rate_metrics(df)))
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    return df.withColumns({"_processed_at": stamp, "_job_name": F.lit(job_name)})


def deduplicate(df: DataFrame, key=SILVER_KEY, order=("_processed_at",)) -> DataFrame:
    """Keep the greatest row per key by ``order`` (then by all other columns).

    One struct per row, order columns first, and its ``max``: the aggregate is combined map-side, so a key holding a
    large share of the rows is reduced inside each input partition before the shuffle, and each row travels once. The
    struct's order is total, so the survivor does not depend on input order.
    """
    others = [x for x in df.columns if x not in key]
    first = [x for x in order if x in others]
    row = F.struct(*first, *[x for x in others if x not in first])
    return df.groupBy(*key).agg(F.max(row).alias("_row")).select(*key, "_row.*").select(*df.columns)


def quality_counts(df: DataFrame) -> DataFrame:
    """Inline Silver checks in one pass: NULL counts and negative views."""
    return df.agg(
        *[F.count_if(F.col(x).isNull()).alias(f"null_{x}")
          for x in ("video_id", "title", "channel_title", "views")],
        F.count_if(F.col("views") < 0).alias("negative_views"),
    )


def quality_report(df: DataFrame) -> dict:
    row = quality_counts(df).first().asDict()
    return {
        "nulls": {k[len("null_"):]: int(v) for k, v in row.items() if k.startswith("null_")},
        "negative_views": int(row["negative_views"]),
    }


def build_silver(raw: DataFrame, job_name: str = "silver", processed_at: Column | None = None,
                 dedup: bool = True) -> DataFrame:
    silver = cleanse(to_canonical(raw), job_name, processed_at)
    return deduplicate(silver) if dedup else silver
