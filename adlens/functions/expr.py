"""Column-expression helpers shared by every operator.

All helpers return JVM-side ``Column`` expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from adlens.config import NA_TOKENS, RAW_DATE_FORMAT

# Money is summed as a decimal plus what the decimal leaves over, so that no
# digit of a value is cut and the sum does not depend on the order in which
# tasks add up their rows.
MONEY = DecimalType(38, 12)
# From here on a double has no digits below 1.
WHOLE = 2.0 ** 53

# A character that no plain number has. Text with one ('NaN', 'Infinity', a
# type suffix such as '1d', hex floats) is rejected before `try_cast`, which
# would accept those. One search for such a character costs a quarter of
# `translate`, which looks up each one.
NO_NUMBER_CHAR = r"[^0-9.+\-eE ]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: Column | str, digits: int) -> Column:
    """SQL ``ROUND(x, n)`` on a double: half away from zero on ``x * 10^n``.

    ``F.round`` rounds the decimal text of the double instead, which gives
    another answer on values such as 1.005; this form is the one every
    rounded column in the library goes through. Where ``x * 10^n`` is so large
    that a double holds no digit below 1, and for infinities and NaN, ``x`` is
    returned as it is.
    """
    x = _c(c).cast("double")
    p = 10.0 ** digits
    scaled = F.abs(x) * F.lit(p)
    rounded = F.signum(x) * F.floor(scaled + F.lit(0.5)) / F.lit(p)
    return F.when(scaled < F.lit(WHOLE), rounded).otherwise(x)


def round_half_away_value(x: float, digits: int) -> float:
    """`round_half_away` for a single Python number (driver-side summaries)."""
    p = 10.0 ** digits
    return math.copysign(math.floor(abs(x) * p + 0.5), x) / p if abs(x) * p < WHOLE else x


def ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """``num / NULLIF(den, 0) * scale``: NULL instead of a division by zero."""
    q = _c(num) / F.nullif(_c(den), F.lit(0))
    return q * F.lit(scale) if scale != 1.0 else q


def whole_number(c: Column | str) -> Column:
    """Text to BIGINT; NULL where the text is no whole number that fits.

    Whole numbers are read as such, not through a double, so long ids keep
    all digits; ``12.0`` is read as 12, but ``3.7`` is no whole number.
    """
    x = F.trim(_c(c))
    # the search is for those with a point only: most ids have none
    return F.when(F.contains(x, F.lit(".")), F.regexp_replace(x, r"\.0*$", "")).otherwise(x).try_cast("bigint")


def money_sum(c: Column | str, window=None) -> Column:
    """Sum of a money column as a double, the same in any order of its rows.

    Each value is split into a decimal of 12 places, summed exactly, and the
    rest that does not fit it (below 1e-12, or the whole of a value of 1e26 or
    more), summed as a double. Where the decimal sum itself has no room the
    plain double sum is given. With ``window``, the sum is taken over it.
    """
    x = _c(c).cast("double")
    part = x.try_cast(MONEY)
    rest = x - F.coalesce(part.cast("double"), F.lit(0.0))

    def over(aggregate):
        return aggregate if window is None else aggregate.over(window)

    exact = over(F.try_sum(F.coalesce(part, F.lit(0).cast(MONEY)))).cast("double")
    return F.when(over(F.count(x)) > 0, F.coalesce(exact + over(F.sum(rest)), over(F.sum(x))))


def money_parts(c: Column | str, name: str) -> list[Column]:
    """Aggregates from which ``merged_money`` gives ``money_sum`` over several groups, to the last digit.

    The decimal part and the rest are kept apart; the decimal is NULL where it had no room.
    """
    x = _c(c).cast("double")
    part = x.try_cast(MONEY)
    return [F.try_sum(F.coalesce(part, F.lit(0).cast(MONEY))).cast(MONEY).alias(f"{name}_exact"),
            F.sum(x - F.coalesce(part.cast("double"), F.lit(0.0))).alias(f"{name}_rest"),
            F.sum(x).alias(f"{name}_plain"), F.count(x).alias(f"{name}_count")]


def merged_money(name: str) -> Column:
    """``money_sum`` of all rows behind the ``money_parts`` in a group."""
    held = F.sum(f"{name}_count")
    exact = F.when(F.count_if(F.col(f"{name}_exact").isNull()) == 0, F.try_sum(f"{name}_exact")).cast("double")
    return F.when(held > 0, F.coalesce(exact + F.sum(f"{name}_rest"), F.sum(f"{name}_plain")))


def exact_mean(c: Column | str) -> Column:
    """Mean of a money-like column from its exact sum; NULLs are skipped."""
    return money_sum(c) / F.nullif(F.count(_c(c)), F.lit(0))


def na_to_null(c: Column | str) -> Column:
    """Missing-value tokens of a CSV reader become NULL."""
    x = _c(c)
    return F.when(~x.isin(*NA_TOKENS), x)


def clean_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    x = _c(c)
    return F.when(~x.rlike(NO_NUMBER_CHAR), x.try_cast("double"))


def parse_day_first(c: Column | str, name: str = "date") -> Column:
    """Day-first date text (``17/08/2017``) or ISO text to a date.

    Text that is present but matches neither form stops the job, as the
    reference's date parser does.
    """
    x = _c(c)
    # each form is tried once and only if the one before failed: a filter on the date inlines
    # the whole expression, which must stay small enough to be compiled
    return F.coalesce(
        F.try_to_date(x, RAW_DATE_FORMAT),
        F.try_to_date(x, "yyyy-MM-dd"),
        F.when(x.isNotNull(), F.raise_error(F.concat(F.lit(f"unparsable {name}: "), x))).cast("date"),
    )


def fixed(c: Column | str, digits: int) -> Column:
    """Number as text with exactly ``digits`` decimals (after `round_half_away`)."""
    return round_half_away(c, digits).cast(DecimalType(38, digits)).cast("string")


def with_scalars(df, aggs: list[Column], source=None):
    """``df`` with the values of ungrouped aggregates ``aggs`` as extra columns.

    The aggregates run over ``source`` (default ``df``) with no grouping, so
    they yield exactly one row; it is broadcast and attached to every row
    of ``df``. Nothing is paired: each row gains the same scalars, as a
    scalar subquery would give it. (This replaces ``SUM(x) OVER ()``, which
    would pull every row into one task.)
    """
    return attach_row(df, (source if source is not None else df).agg(*aggs))


def attach_row(df, one_row):
    """Every row of ``df`` with the columns of ``one_row``, broadcast.

    ``one_row`` must be an ungrouped aggregate (exactly one row, whatever
    the data size), so the product has exactly as many rows as ``df``.
    """
    return df.crossJoin(F.broadcast(one_row))
