"""Exact ranks and row numbers inside groups of any size, by distributed prefix sums.

A window over (market, date) would sort a whole market-day in one task. Here the rows are dealt once, by range over
(group, value, tie-break), so neither a large group nor a value that a third of the rows share stays in one task:

1. rows are range-partitioned; a row's part is the range it fell into, and a group's rows lie in consecutive parts;
2. windows inside (part, group) give each row's local place and that of its run of equal values; the rows are written
   once (a reliable checkpoint), as the bounds of ranges are sampled and must be the same for all that follows;
3. one small row for each (part, group) (its rows, distinct values, first and last value) gets prefix sums over the
   group's parts; where a run of equal values goes on into the next part, its start and end are carried along;
4. rows take the sums of their (part, group), and every rank is integer arithmetic over them.

Equal rows of (group, value, tie-break) are dealt by a hash of the row, values keep their own type and are only ever
compared, and a descending order is counted from the other end, so ties are exact and row numbers unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.session import cut

#: Sums of so many (part, group) at most, a few hundred bytes each, are sent to every task.
SENT = 50_000


def dealt(df: DataFrame, group: list[str], value: str, tie_break=()) -> DataFrame:
    """``df`` with each row's part, and inside its (part, group) the place of the row, the first and last place of its
    run of equal values, and the number of the run. Two exchanges: by range, then by (part, group);
    the third, in ``_sums``, has one small row for each (part, group)."""
    ties = [F.col(t).asc_nulls_first() for t in tie_break] + [F.xxhash64(*df.columns).asc()]
    order = [*[F.col(g).asc_nulls_first() for g in group], F.col(value).asc_nulls_first(), *ties]
    # the group as one struct, which is never null and equal where its fields are, null or not
    parted = df.repartitionByRange(*order).withColumns({"_part": F.spark_partition_id(), "_group": F.struct(*group)})
    inside = Window.partitionBy("_part", "_group")
    by_value = inside.orderBy(F.col(value).asc_nulls_first())
    placed = parted.withColumn("_at", F.row_number().over(inside.orderBy(F.col(value).asc_nulls_first(), *ties)))
    return placed.withColumns({
        "_start": F.rank().over(by_value), "_dense": F.dense_rank().over(by_value),
        "_end": F.count(F.lit(1)).over(by_value.rangeBetween(Window.unboundedPreceding, Window.currentRow))})


def _sums(rows: DataFrame, value: str) -> DataFrame:
    """Per (part, group): rows and distinct values before it, the true start and end of the runs at its ends, and the
    totals of the group."""
    v = F.col(value)
    parts = rows.groupBy("_part", "_group").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_dense").alias("_d"), F.max(F.when(F.col("_start") == 1, v)).alias("_first"),
        F.max(v).alias("_last"), F.max("_start").alias("_last_start"), F.min("_end").alias("_first_end"),
        F.count_if(v.isNull()).alias("_null"))
    whole = Window.partitionBy("_group")
    series = whole.orderBy("_part")
    before, after = series.rowsBetween(Window.unboundedPreceding, -1), series.rowsBetween(1, Window.unboundedFollowing)
    parts = parts.withColumns({
        "_r0": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_goes_on": F.lag("_part").over(series).isNotNull() & F.lag("_last").over(series).eqNullSafe(F.col("_first")),
        "_continues": F.lead("_part").over(series).isNotNull() & F.lead("_first").over(series).eqNullSafe(F.col("_last"))})
    parts = parts.withColumns({
        "_new_start": F.expr("CASE WHEN NOT (_d = 1 AND _goes_on) THEN _r0 + _last_start END"),
        "_new_end": F.expr("CASE WHEN NOT (_d = 1 AND _continues) THEN _r0 + _first_end END"),
        "_again": F.col("_goes_on").cast("long"), "_has_null": (F.col("_null") > 0).cast("long")})
    return parts.select(
        "_part", "_group", "_d", "_r0",
        (F.coalesce(F.sum("_d").over(before), F.lit(0)) - F.sum("_again").over(series.rowsBetween(Window.unboundedPreceding, 0))).alias("_d0"),
        "_goes_on", "_continues",
        F.last("_new_start", ignorenulls=True).over(before).alias("_run_start"),
        F.first("_new_end", ignorenulls=True).over(after).alias("_run_end"),
        F.sum("_n").over(whole).alias("_rows"), F.sum("_null").over(whole).alias("_nulls"),
        (F.sum("_d").over(whole) - F.sum("_again").over(whole) - F.max("_has_null").over(whole)).alias("_values"))


#: Places of a row in its whole group, from its places in its part: its number, and the ends of its run of equal values.
_GLOBAL = {
    "_number": "_r0 + _at",
    "_below": "CASE WHEN _dense = 1 AND _goes_on THEN _run_start ELSE _r0 + _start END - 1",
    "_upto": "CASE WHEN _dense = _d AND _continues THEN _run_end ELSE _r0 + _end END",
    "_values_below": "_d0 + _dense - 1 - CAST(_nulls > 0 AS INT)",
}


def _result(method: str, descending: bool, value: str) -> Column:
    """Ascending orders have NULLs first, descending ones last."""
    if method == "percent_score":
        return F.expr("CASE WHEN _rows > 1 THEN (_below * 20000 + (_rows - 1)) div (2 * (_rows - 1)) / 100.0D ELSE 0.0D END")
    if method == "rank":
        return F.expr("CAST(_rows - _upto + 1 AS INT)" if descending else "CAST(_below + 1 AS INT)")
    if method == "row_number":
        return F.expr("CAST(_rows - _upto + _number - _below AS INT)" if descending else "CAST(_number AS INT)")
    if method == "dense_rank":
        null = F.col(value).isNull()
        if descending:
            return F.when(null, F.col("_values") + 1).otherwise(F.col("_values") - F.col("_values_below")).cast("int")
        return F.when(null, F.lit(1)).otherwise(F.expr("_values_below + 1 + CAST(_nulls > 0 AS INT)")).cast("int")
    raise ValueError(f"unsupported method {method}")


def _placed(df: DataFrame, group: list[str], value: str, tie_break=()) -> DataFrame:
    """``df`` with the places of each row in its whole group."""
    rows = cut(dealt(df, group, value, tie_break))
    # a (part, group) is at most a part, so the join has no large key. Written rows are known to lie by it only if the
    # plan was not adaptive; otherwise the sums are sent to the rows, unless there are very many groups
    sums = _sums(rows, value)
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and rows.select("_part", "_group").distinct().limit(SENT + 1).count() <= SENT:
        sums = F.broadcast(sums)
    joined = rows.join(sums, ["_part", "_group"])
    return joined.withColumns({name: F.expr(sql) for name, sql in _GLOBAL.items()})


def with_ranks(df: DataFrame, group, value: str, outs: dict[str, tuple[str, bool]], tie_break=()) -> DataFrame:
    """Several ranks of one value in one pass; ``outs``: column -> (method, descending).

    Methods: ``rank``, ``dense_rank``, ``row_number`` (rows of equal value numbered by ``tie_break``) and
    ``percent_score``: ``percent_rank * 100`` at 2 places, HALF_UP in integers. Groups and values compare null-safely.
    The dealt rows are written when this is called.
    """
    placed = _placed(df, list(group), value, tie_break)
    return placed.select(*df.columns, *[_result(*how, value).alias(name) for name, how in outs.items()])


def with_ranks_of(df: DataFrame, group, values: dict[str, dict[str, tuple[str, bool]]], tie_break=()) -> DataFrame:
    """``with_ranks`` of several values, one after another."""
    for value, outs in values.items():
        df = with_ranks(df, group, value, outs, tie_break)
    return df


def rank_within(df: DataFrame, group, value: str, out: str, method: str = "rank", descending: bool = False,
                tie_break=()) -> DataFrame:
    """One rank inside ``group``; see ``with_ranks``."""
    return with_ranks(df, group, value, {out: (method, descending)}, tie_break)


def numbered(df: DataFrame, group, order: list[str], index: str, rows: str) -> DataFrame:
    """``df`` with each row's place in its group (from 0, ascending by ``order``, nulls first) and the group's rows."""
    placed = _placed(df, list(group), order[0], order[1:])
    return placed.select(*df.columns, (F.col("_number") - 1).cast("long").alias(index), F.col("_rows").alias(rows))


def percentile_score(df: DataFrame, group, value: str, out: str) -> DataFrame:
    """Percent rank x 100 at 2 decimals, ascending, NULLs first (they score 0)."""
    return with_ranks(df, group, value, {out: ("percent_score", False)})


def percentile_score_small(df: DataFrame, group, value: str, out: str) -> DataFrame:
    """``percentile_score`` by plain windows, for groups that are small by nature (the categories of a market-day)."""
    whole = Window.partitionBy(*group)
    rank, rows = F.rank().over(whole.orderBy(F.col(value).asc_nulls_first())), F.count(F.lit(1)).over(whole)
    df = df.withColumns({"_below": (rank - 1).cast("long"), "_rows": rows})
    return df.withColumn(out, _result("percent_score", False, value)).drop("_below", "_rows")


def top_n(df: DataFrame, group, value: str, n: int, out: str = "rank", tie_break=()) -> DataFrame:
    """``row_number() <= n`` per group, highest ``value`` first.

    Catalyst plans this as a partial ``WindowGroupLimit`` before the shuffle, so each input partition ships at most
    ``n`` rows per group.
    """
    order = [F.col(value).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in tie_break]]
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(out) <= n)
