"""Data-quality gate over full tables (no sampling).

Per table, row count, NULL shares, value ranges, freshness and score bounds
come out of ONE aggregate pass; uniqueness of the grain is a second pass
(``groupBy(key).count()`` then a sum of the duplicated groups, counting every
copy). Only the small per-check report reaches the driver.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig
from trendspark.functions.columns import scaled
from trendspark.oracle.duckdb_sql import sc

# fixed values: critical columns, natural keys and score bounds per table
CRITICAL_COLUMNS = {
    "clean_statistics": ["video_id", "title", "channel_title", "views", "region"],
    "video_trends": ["video_id", "region", "snapshot_date", "views", "trend_stage"],
    "category_analytics": ["category_id", "category_name", "region", "snapshot_date"],
    "channel_analytics": ["channel_id", "channel_title", "region", "snapshot_date"],
    "trend_opportunities": ["snapshot_date", "scope", "entity_id", "trend_score"],
}
UNIQUE_KEYS = {
    "clean_statistics": ["video_id", "region", "trending_date_parsed"],
    "video_trends": ["video_id", "region", "snapshot_date"],
    "category_analytics": ["category_id", "region", "snapshot_date"],
    "channel_analytics": ["channel_id", "region", "snapshot_date"],
    "trend_opportunities": ["scope", "region", "entity_id", "snapshot_date"],
}
METRIC_BOUNDS = {
    "trend_opportunities": [("trend_score", 0, 100), ("velocity_score", 0, 100),
                            ("engagement_score", 0, 100), ("market_expansion_score", 0, 100)],
    "video_trends": [("persistence_score", 0, 100)],
}
FRESHNESS_COLUMNS = ("_processed_at", "_ingestion_timestamp", "_aggregated_at")

def _pct(nulls: str, rows: str) -> Column:
    """NULL share in percent at 2 places (exact HALF_UP); 0.0 for an empty table."""
    return F.expr(f"CASE WHEN {rows} > 0 THEN {scaled(nulls, rows, 2, times=100)} ELSE 0.0D END")


def profile_metrics(columns: list[str], table: str, cfg: TrendConfig = DEFAULT) -> tuple[list[Column], str | None]:
    """Every count the non-key checks need, as aggregates over a table with these columns, and its time column."""
    cols = set(columns)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for col in CRITICAL_COLUMNS.get(table, []):
        if col in cols:
            aggs.append(F.count_if(F.col(col).isNull()).alias(f"null__{col}"))
    if table == "clean_statistics" and "views" in cols:
        aggs.append(F.count_if(F.col("views") < 0).alias("negative_views"))
        aggs.append(F.count_if(F.col("views") > cfg.dq_max_views).alias("extreme_views"))
    for col, lo, hi in METRIC_BOUNDS.get(table, []):
        if col in cols:
            aggs.append(F.count_if((F.col(col) < lo) | (F.col(col) > hi)).alias(f"oob__{col}"))
    ts = next((c for c in FRESHNESS_COLUMNS if c in cols), None)
    if ts is not None:
        # as microseconds since 1970 in UTC: a timestamp would reach the driver in its own time zone
        aggs.append(F.unix_micros(F.max(F.col(ts).cast("string").try_cast("timestamp"))).alias("latest"))
        aggs.append(F.count(F.col(ts)).alias("ts_present"))
    return aggs, ts


def table_profile(df: DataFrame, table: str, cfg: TrendConfig = DEFAULT) -> dict:
    """One aggregate job over a table."""
    aggs, ts = profile_metrics(df.columns, table, cfg)
    return {"row": df.agg(*aggs).first().asDict(), "ts_column": ts, "columns": set(df.columns)}


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once, counting every copy (one row out)."""
    return (df.groupBy(*keys).count().where(F.col("count") > 1)
            .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("duplicate_row_count")))


def _check(check: str, table: str, passed: bool, message: str, **more) -> dict:
    return {"check": check, "table": table, "passed": bool(passed), "message": message, **more}


def check_table(df: DataFrame, table: str, cfg: TrendConfig = DEFAULT,
                now: datetime | None = None, profile: dict | None = None) -> list[dict]:
    """All checks of a table; with the ``profile`` observed while it was written, only its key columns are read."""
    prof = profile or table_profile(df, table, cfg)
    row, cols = prof["row"], prof["columns"]
    n, critical = int(row["rows"]), CRITICAL_COLUMNS.get(table, [])
    missing = sorted(set(critical) - cols)
    out = [_check("row_count", table, n >= cfg.dq_min_rows, f"{n} rows, at least {cfg.dq_min_rows} wanted",
                  value=n, threshold=cfg.dq_min_rows)]
    for col in critical:
        if col in missing:
            out.append(_check("null_pct", table, False, f"no column {col}", column=col))
            continue
        pct = round(row[f"null__{col}"] / n * 100, 2) if n else 0.0
        out.append(_check("null_pct", table, pct <= cfg.dq_max_null_pct,
                          f"{pct:.2f}% of {col} are null, limit {cfg.dq_max_null_pct}%",
                          column=col, value=pct, threshold=cfg.dq_max_null_pct))
    out.append(_check("schema", table, not missing, f"columns not found: {', '.join(missing) or 'none'}",
                      missing_columns=missing))
    if "negative_views" in row:
        low, high = int(row["negative_views"]), int(row["extreme_views"])
        out.append(_check("value_range", table, low == high == 0,
                          f"{low} rows with views below zero, {high} above {cfg.dq_max_views}",
                          column="views", negative_count=low, extreme_count=high))
    out += [_freshness(prof, table, cfg, now), _uniqueness(df, table, cols)]
    for col, lo, hi in METRIC_BOUNDS.get(table, []):
        if col in cols:
            bad = int(row[f"oob__{col}"])
            out.append(_check("metric_sanity", table, bad == 0, f"{bad} values of {col} lie beyond {lo} to {hi}",
                              column=col, out_of_bounds_count=bad, expected_range=[lo, hi]))
    return out


def _freshness(prof: dict, table: str, cfg: TrendConfig, now: datetime | None) -> dict:
    if prof["ts_column"] is None:
        return _check("freshness", table, True, "skipping: the table has no time column")
    micros = prof["row"].get("latest")
    if micros is None:
        return _check("freshness", table, True, f"skipping: Could not parse any time in {prof['ts_column']}")
    latest = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)
    cutoff = (now or datetime.now(timezone.utc)) - timedelta(hours=cfg.dq_freshness_hours)
    return _check("freshness", table, latest >= cutoff, f"newest row of {latest}, limit {cutoff}",
                  latest_record=str(latest), cutoff=str(cutoff))


def _uniqueness(df: DataFrame, table: str, cols: set, keys: list[str] | None = None) -> dict:
    keys = keys if keys is not None else UNIQUE_KEYS.get(table, [])
    if not keys or not all(k in cols for k in keys):
        return _check("uniqueness", table, True, "skipping: the table lacks its key")
    dup = int(duplicate_rows(df, keys).first()["duplicate_row_count"])
    return _check("uniqueness", table, dup == 0, f"{dup} rows share their {', '.join(keys)}",
                  key_columns=keys, duplicate_row_count=dup)


def run_checks(tables: dict[str, DataFrame | str], cfg: TrendConfig = DEFAULT,
               now: datetime | None = None, profiles: dict[str, dict] | None = None) -> dict:
    """Gate over several tables, given as frames or as paths; one that cannot be opened or read is a failed
    ``read_table``. ``profiles`` holds what writes observed."""
    results: list[dict] = []
    for name, df in tables.items():
        try:
            if isinstance(df, str):
                df = SparkSession.active().read.parquet(df)
            results.extend(check_table(df, name, cfg, now, (profiles or {}).get(name)))
        except Exception as exc:  # noqa: BLE001 - reported as a failed check
            results.append(_check("read_table", name, False, str(exc)))
    passed = sum(1 for r in results if r["passed"])
    total = len(results)
    return {
        "quality_passed": all(r["passed"] for r in results),
        "quality_score": round(passed / total * 100, 2) if total else 100.0,
        "checks_passed": passed, "checks_failed": total - passed, "checks_total": total,
        "details": results,
    }


class QualityGateError(RuntimeError):
    pass


def assert_quality(summary: dict) -> dict:
    if not summary["quality_passed"]:
        failed = [r for r in summary["details"] if not r["passed"]]
        raise QualityGateError(f"{len(failed)} data-quality check(s) failed: {failed}")
    return summary


# ---- registered, SQL-checkable forms --------------------------------------

def _nulls_frame(layers) -> DataFrame:
    df = layers.silver
    cols = CRITICAL_COLUMNS["clean_statistics"]
    agg = df.agg(F.count(F.lit(1)).alias("row_count"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = agg.select(
        "row_count",
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                            for c in cols])).alias("x"))
    return stacked.select(
        F.lit("clean_statistics").alias("table_name"), "x.column_name", "x.null_count", "row_count",
        _pct("x.null_count", "row_count").alias("null_pct"),
        (_pct("x.null_count", "row_count") <= DEFAULT.dq_max_null_pct).alias("passed"))


def _ranges_frame(layers) -> DataFrame:
    return layers.silver.agg(
        F.count_if(F.col("views") < 0).alias("negative_count"),
        F.count_if(F.col("views") > DEFAULT.dq_max_views).alias("extreme_count"),
    ).select(F.lit("clean_statistics").alias("table_name"), "*",
             ((F.col("negative_count") == 0) & (F.col("extreme_count") == 0)).alias("passed"))


def _tables(layers) -> dict[str, DataFrame]:
    return {"clean_statistics": layers.silver, "video_trends": layers.video_trends,
            "category_analytics": layers.category, "channel_analytics": layers.channel,
            "trend_opportunities": layers.opportunities}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _unique_frame(layers) -> DataFrame:
    return _union([
        duplicate_rows(df, UNIQUE_KEYS[name]).select(
            F.lit(name).alias("table_name"), "duplicate_row_count",
            (F.col("duplicate_row_count") == 0).alias("passed"))
        for name, df in _tables(layers.shared()).items()])


REPORT_NOW = "TIMESTAMP '2026-01-02 00:00:00'"


def _report_frame(layers) -> DataFrame:
    """All single-pass checks over all five tables: (table_name, check, column_name, value, passed)."""
    def rows_of(name: str, df: DataFrame) -> DataFrame:
        critical = CRITICAL_COLUMNS[name]
        missing = len([c for c in critical if c not in df.columns])
        nulls = {c: F.count_if(F.col(c).isNull()) for c in critical if c in df.columns}
        stamp = next((c for c in FRESHNESS_COLUMNS if c in df.columns), None)
        age = f"unix_timestamp({REPORT_NOW}) - unix_timestamp(max({stamp}))" if stamp else "CAST(NULL AS BIGINT)"
        one = df.agg(F.count(F.lit(1)).alias("n"), F.expr(age).alias("age"), *[x.alias(f"null__{c}") for c, x in nulls.items()])
        limit = DEFAULT.dq_freshness_hours * 3600
        found = [("row_count", "''", "n", f"n >= {DEFAULT.dq_min_rows}"),
                 ("schema", "''", f"{missing}L", f"{missing} = 0"),
                 ("freshness", "''", "age", f"coalesce(age <= {limit}, true)")]
        found += [("null_pct", f"'{c}'", f"null__{c}", f"null__{c} * 100 <= n * {DEFAULT.dq_max_null_pct}D") for c in nulls]
        struct = ", ".join(f"struct('{check}' AS check, {column} AS column_name, CAST({value} AS BIGINT) AS value, {passed} AS passed)"
                           for check, column, value, passed in found)
        return one.select(F.lit(name).alias("table_name"), F.expr(f"inline(array({struct}))"))

    rows = _union([rows_of(name, df) for name, df in _tables(layers.shared()).items()])
    total = rows.agg(F.count_if(~F.col("passed")).alias("value")).select(
        F.lit("all").alias("table_name"), F.lit("summary").alias("check"), F.lit("").alias("column_name"), "value",
        (F.col("value") == 0).alias("passed"))
    return rows.unionByName(total)


def _bounds_frame(layers) -> DataFrame:
    layers = layers.shared()
    tables = {"trend_opportunities": layers.opportunities, "video_trends": layers.video_trends}
    out = None
    for name, df in tables.items():
        bounds = METRIC_BOUNDS[name]
        agg = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, lo, hi in bounds])
        one = agg.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("out_of_bounds_count"))
            for c, _, _ in bounds])).alias("x")).select(
            F.lit(name).alias("table_name"), "x.column_name", "x.out_of_bounds_count",
            (F.col("x.out_of_bounds_count") == 0).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


CHECK_FRAMES = {"dq_nulls": _nulls_frame, "dq_ranges": _ranges_frame,
                "dq_uniqueness": _unique_frame, "dq_bounds": _bounds_frame,
                "dq_report": _report_frame}


def _oracle_nulls() -> str:
    parts = []
    for c in CRITICAL_COLUMNS["clean_statistics"]:
        nulls = f"(count(*) FILTER (WHERE {c} IS NULL))"
        exact = sc(f"{nulls} * 100", "count(*)", 2)
        pct = f"CASE WHEN count(*) > 0 THEN {exact} ELSE 0.0::DOUBLE END"
        parts.append(
            f"SELECT 'clean_statistics' AS table_name, '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count, "
            f"{pct} AS null_pct, {pct} <= {DEFAULT.dq_max_null_pct}::DOUBLE AS passed FROM silver")
    return " UNION ALL ".join(parts)


def _oracle_unique() -> str:
    ctes = {"clean_statistics": "silver", "video_trends": "video_trends",
            "category_analytics": "category", "channel_analytics": "channel",
            "trend_opportunities": "opportunities"}
    parts = []
    for name, cte in ctes.items():
        keys = ", ".join(UNIQUE_KEYS[name])
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_row_count, "
            f"coalesce(sum(n), 0) = 0 AS passed FROM (SELECT count(*) AS n FROM {cte} "
            f"GROUP BY {keys} HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


def _oracle_bounds() -> str:
    ctes = {"trend_opportunities": "opportunities", "video_trends": "video_trends"}
    parts = []
    for name, cte in ctes.items():
        for c, lo, hi in METRIC_BOUNDS[name]:
            cnt = f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})"
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                         f"{cnt} AS out_of_bounds_count, {cnt} = 0 AS passed FROM {cte}")
    return " UNION ALL ".join(parts)


def _oracle_report() -> str:
    ctes = {"clean_statistics": "silver", "video_trends": "video_trends", "category_analytics": "category",
            "channel_analytics": "channel", "trend_opportunities": "opportunities"}
    parts = []
    for name, cte in ctes.items():
        age = "CAST(86400 AS BIGINT)" if name == "clean_statistics" else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT '{name}' AS table_name, 'row_count' AS \"check\", '' AS column_name, count(*) AS value, count(*) >= 10 AS passed FROM {cte}")
        parts.append(f"SELECT '{name}', 'schema', '', CAST(0 AS BIGINT), true")
        parts.append(f"SELECT '{name}', 'freshness', '', {age}, true")
        parts += [f"SELECT '{name}', 'null_pct', '{c}', count(*) - count({c}), (count(*) - count({c})) * 20 <= count(*) FROM {cte}"
                  for c in CRITICAL_COLUMNS[name]]
    every = " UNION ALL ".join(parts)
    return (f"SELECT * FROM ({every}) UNION ALL SELECT 'all', 'summary', '', count(*) FILTER (WHERE NOT passed), "
            f"count(*) FILTER (WHERE NOT passed) = 0 FROM ({every})")


ORACLE = {
    "dq_report": _oracle_report(),
    "dq_nulls": _oracle_nulls(),
    "dq_ranges": (f"SELECT 'clean_statistics' AS table_name, "
                  f"count(*) FILTER (WHERE views < 0) AS negative_count, "
                  f"count(*) FILTER (WHERE views > {DEFAULT.dq_max_views}) AS extreme_count, "
                  f"(count(*) FILTER (WHERE views < 0)) = 0 AND "
                  f"(count(*) FILTER (WHERE views > {DEFAULT.dq_max_views})) = 0 AS passed FROM silver"),
    "dq_uniqueness": _oracle_unique(),
    "dq_bounds": _oracle_bounds(),
}
