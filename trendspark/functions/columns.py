"""Column-returning helpers (all JVM-side built-ins, no Python UDFs).

Parsing of external text uses the ANSI-safe ``try_*`` forms: with ANSI mode on
(the Spark 4 default) ``cast``/``to_date``/``to_timestamp`` raise on junk,
the ``try_`` forms give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendspark.config import DEFAULT, TrendConfig

_YY_DD_MM = r"^\d{2}\.\d{2}\.\d{2}$"


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


#: Largest magnitude of a numerator for which the doubled, scaled value stays a long.
_LONG_ROOM = 4_000_000_000_000_000_000


def _terms(num: str | tuple[str, ...]) -> list[str]:
    return [num] if isinstance(num, str) else list(num)


def half_up_quotient(num: str | tuple[str, ...], den: str, times: int = 1) -> str:
    """SQL text: ``num * times / den`` rounded HALF_UP (away from zero) to a whole number, as a DOUBLE.

    ``num`` is an integer expression or several to be added up; a term that starts with ``-`` is subtracted. Exact for
    any long: where the scaled numerator might leave the long range, the same division is done in DECIMAL(38, 0). A
    negative divisor turns the sign of both; a NULL or zero divisor gives NULL. (``round(double)`` would go through the
    double's printed form, row by row.)
    """
    terms = [t.strip() for t in _terms(num)]
    parts = [(t[1:], "-") if t.startswith("-") else (t, "+") for t in terms]
    room = _LONG_ROOM // (2 * times * len(parts))
    fits = " AND ".join(f"({x}) BETWEEN -{room} AND {room}" for x, _ in parts)
    fits += f" AND ({den}) BETWEEN -{_LONG_ROOM // 4} AND {_LONG_ROOM // 4}"

    def total(form: str) -> str:
        return "(" + " ".join(f"{sign} {form.format(x)}" for x, sign in parts) + ")"

    n, d = total("({})"), f"({den})"
    wide_n, wide_d = total("CAST(({}) AS DECIMAL(20,0))"), f"CAST({d} AS DECIMAL(20,0))"
    wide_up = f"(2 * abs({wide_n}) * {times} + abs({wide_d}))"
    return (f"(CASE WHEN ({den}) = 0 THEN NULL "
            f"WHEN {fits} THEN CAST(sign({n}) * sign({d}) AS INT) "
            f"* CAST((2 * {times} * abs({n}) + abs({d})) div (2 * abs({d})) AS DOUBLE) "
            f"ELSE CAST(sign({wide_n}) * sign({wide_d}) AS INT) "
            f"* CAST(({wide_up} - {wide_up} % (2 * abs({wide_d}))) / (2 * abs({wide_d})) AS DOUBLE) END)")


def scaled(num: str | tuple[str, ...], den: str, places: int, times: int = 1) -> str:
    """SQL text: ``num * times / den`` at ``places`` decimals (HALF_UP) as a DOUBLE."""
    unit = 10 ** places
    return f"({half_up_quotient(num, den, unit * times)} / {unit}.0D)"


def ratio(num: str | tuple[str, ...], den: str, places: int, times: int = 1) -> Column:
    """``num / den * times`` at ``places`` decimals when ``den > 0``, else 0.0."""
    return F.expr(f"CASE WHEN ({den}) > 0 THEN {scaled(num, den, places, times)} ELSE 0.0D END")


def growth(cur: str, prev: str, places: int, times: int = 1) -> Column:
    """Relative change vs. the previous value; NULL without a usable baseline (none, or zero)."""
    return F.expr(f"CASE WHEN ({prev}) <> 0 THEN {scaled((cur, '-' + prev), prev, places, times)} END")


def duration_seconds(col) -> Column:
    """ISO-8601 duration text (``PT1H2M3S``) to whole seconds; NULL stays NULL.

    Hours, minutes and seconds are each optional; a day part is not counted.
    """
    def part(unit: str) -> Column:
        digits = F.regexp_extract(c(col), rf"(\d+){unit}", 1)
        # an absent unit extracts '' -> 0 without a (slow, failing) try_cast
        return F.when(digits == "", F.lit(0)).otherwise(
            F.coalesce(digits.try_cast("int"), F.lit(0)))

    total = part("H") * 3600 + part("M") * 60 + part("S")
    return F.when(c(col).isNotNull(), total).otherwise(F.lit(None).cast("int"))


def snapshot_date(col) -> Column:
    """``YY.DD.MM`` (legacy CSV) or ISO date text to DATE; junk gives NULL."""
    return (
        F.when(c(col).rlike(_YY_DD_MM), F.try_to_date(c(col), "yy.dd.MM"))
        .otherwise(F.try_to_date(c(col)))
    )


def units(col, unit: int) -> Column:
    """A value already rounded to ``log10(unit)`` places as an exact integer.

    The product is within float error of an integer, so ``rint`` is exact and
    avoids the per-row ``BigDecimal`` of ``round``.
    """
    return F.rint(c(col) * unit).cast("long")


def hundredths(col) -> Column:
    """A value already rounded to 2 places as an exact integer count of 0.01."""
    return units(col, 100)


def weighted_score(parts: list[tuple[Column, int]], denominator: int) -> Column:
    """HALF_UP-rounded weighted sum of 2-decimal scores, computed exactly.

    ``parts`` pairs each score column with an integer weight; the weights sum to
    ``denominator`` (weights 0.5/0.3/0.2 are passed as 5/3/2 over 10). Working
    in integer hundredths makes the score independent of floating-point
    summation order, so reruns and different partitionings agree bit for bit.
    """
    n = None
    for col, weight in parts:
        term = hundredths(col) * F.lit(weight)
        n = term if n is None else n + term
    half = denominator // 2
    return F.floor((n + F.lit(half)) / F.lit(denominator)) / F.lit(100.0)


def scaled_mean(col, scale: int) -> Column:
    """Exact mean of a column whose values carry ``log10(scale)`` decimals."""
    return F.sum(units(col, scale)) / (F.count(c(col)) * F.lit(float(scale)))


def trend_stage(cfg: TrendConfig = DEFAULT) -> Column:
    """Lifecycle stage of a video in its market.

    A video is EMERGING on its first day, and while it is young and growing fast; FADING when it shrinks beyond the
    threshold; SUSTAINING when it grows without being an old video of flat growth; everything else is ESTABLISHED.
    """
    rate = "view_growth_rate"
    young = f"trending_days_to_date <= {cfg.emerging_max_days}"
    flat = f"{rate} <= {cfg.emerging_growth_threshold}D"
    old = f"trending_days_to_date > {cfg.established_min_days}"
    return F.expr(f"""CASE
        WHEN is_new_entrant OR ({young} AND NOT {flat}) THEN 'EMERGING'
        WHEN {rate} < {cfg.fading_growth_threshold}D THEN 'FADING'
        WHEN {rate} > 0 AND NOT ({old} AND {flat}) THEN 'SUSTAINING'
        ELSE 'ESTABLISHED' END""")


def fixed1(col) -> Column:
    """Number text with exactly one decimal, the same in every engine."""
    return c(col).cast("decimal(18,1)").cast("string")


def fixed2(col) -> Column:
    return c(col).cast("decimal(18,2)").cast("string")


def half_up(units_col: str, divisor: int, scale: float) -> Column:
    """Whole units divided by ``divisor``, rounded HALF_UP, then by ``scale``, as a DOUBLE."""
    return F.expr(f"({half_up_quotient(units_col, str(divisor))} / {scale!r}D)")
