"""Column helpers shared by the operators; all stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

# Money is added up as a decimal: the sum is exact, so it does not depend on the
# order in which tasks finish or on a task being run again after a lost executor.
MONEY = DecimalType(24, 6)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def exact_sum(column: Column | str) -> Column:
    """Order-independent sum of a double column, returned as double."""
    return F.sum(_col(column).cast(MONEY)).cast("double")


def is_one_of(column: Column | str, values: Iterable[str]) -> Column:
    """``isin`` that answers false, not null, for a null value."""
    return F.coalesce(_col(column).isin(list(values)), F.lit(False))


def not_one_of(column: Column | str, values: Iterable[str]) -> Column:
    """Complement of :func:`is_one_of`; a null value passes."""
    return ~is_one_of(column, values)


def percent_of(part: Column | str, whole: Column | str, digits: int | None = 2) -> Column:
    """``part / whole * 100``, half-even rounded; null when ``whole`` is zero or null."""
    share = F.try_divide(_col(part).cast("double"), _col(whole).cast("double")) * 100
    return share if digits is None else half_even(share, digits)


def half_even(column: Column | str, digits: int) -> Column:
    """Scale, round to the nearest whole number with ties to even, scale back.

    That is how array libraries round.  ``bround`` works on the shortest decimal text
    of the number instead and differs where scaling lands exactly on a tie.
    """
    scale = float(10**digits)
    return F.rint(_col(column) * scale) / scale


def growth_rate(current: Column | str, previous: Column | str) -> Column:
    """``(current - previous) / previous``; null when there is nothing to grow from."""
    return F.try_divide(_col(current) - _col(previous), _col(previous))


def year_month(column: Column | str) -> Column:
    return F.date_format(_col(column), "yyyy-MM")


def title_case(column: Column | str) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` only looks at blanks; here ``o'neil kim-song`` gives ``O'Neil Kim-Song``.
    """
    runs = F.regexp_extract_all(_col(column), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.concat(
                F.upper(F.substring(run, 1, 1)), F.lower(F.substring(run, 2, 2147483647))
            ),
        ),
        "",
    )


def plain_number(column: Column | str) -> Column:
    """Text of a double without an exponent, always with a decimal point."""
    value = _col(column)
    text = value.cast("string")
    wide = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), r"0+$", "")
    wide = F.when(wide.endswith("."), F.concat(wide, F.lit("0"))).otherwise(wide)
    return F.when(text.contains("E"), wide).otherwise(text)
