"""Scalar helpers shared by the builders, merges and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(table: Mapping, col: Column | str) -> Column:
    """Value of a small literal map, NULL for a key it does not hold."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.col(col) if isinstance(col, str) else col)


def zip_code(col: Column | str) -> Column:
    """Five characters with the leading zeros a numeric column lost; longer text is cut."""
    col = F.col(col) if isinstance(col, str) else col
    return F.lpad(col.cast("string"), 5, "0")


def money(col: Column | str, precision: int = 12) -> Column:
    """Exact amount with two decimals. Cast before summing, so totals do not depend on order."""
    col = F.col(col) if isinstance(col, str) else col
    return col.cast(f"decimal({precision},2)")


def ratio(part: Column, whole: Column, digits: int, times: int = 1) -> Column:
    """`times * part / whole` rounded half up to `digits`, NULL for a zero `whole`.

    Counts are integers, so the rounding is done on integers: no binary fraction can push a tie
    to the wrong side.
    """
    whole = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    scaled = part.cast("bigint") * F.lit(2 * times * 10**digits).cast("bigint") + whole
    return F.call_function("div", scaled, whole * 2).cast("double") / F.lit(float(10**digits))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return ratio(part, whole, digits, times=100)


def distinct_from(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs; two NULLs are equal, NULL and a value differ."""
    return ~F.struct(*[c.alias(f"c{i}") for i, c in enumerate(left)]).eqNullSafe(
        F.struct(*[c.alias(f"c{i}") for i, c in enumerate(right)])
    )


def yes(flag: Column) -> Column:
    """1 where the flag is true, else 0 (also for NULL), for counting by sum."""
    return F.when(flag, 1).otherwise(0)
