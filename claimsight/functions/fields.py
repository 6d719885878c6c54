"""Column expressions shared by batch and streaming code. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def token(col: str | Column, length: int = 16) -> Column:
    """Prefix of the SHA-256 hex digest. Null stays null."""
    return F.substring(F.sha2(_c(col), 256), 1, length)


def composite_token(*cols: str | Column) -> Column:
    """Full SHA-256 over the parts joined with ``|``. Null parts are skipped."""
    return F.sha2(F.concat_ws("|", *[_c(c) for c in cols]), 256)


def masked_token(col: str | Column) -> Column:
    """Short token for people to read: ``TKN-`` and six hex digits."""
    return F.concat(F.lit("TKN-"), token(col, 6))


def event_time(col: str | Column) -> Column:
    """Text to timestamp. Text that is no timestamp gives null, not an error."""
    return F.try_to_timestamp(_c(col))


def cents(col: str | Column) -> Column:
    """Money as whole cents, so that sums do not depend on the row order."""
    return F.round(_c(col) * 100, 0).cast("bigint")


def epoch(col: str | Column) -> Column:
    """Whole seconds since 1970 of a timestamp."""
    return F.unix_seconds(_c(col))


def day_of(second: str | Column) -> Column:
    """Day number of an epoch second, also right before 1970."""
    return F.floor(_c(second) / DAY).cast("bigint")


def hour_of_day(col: str | Column) -> Column:
    return F.hour(_c(col))


def is_weekend(col: str | Column) -> Column:
    """1 on Saturday and Sunday."""
    return F.dayofweek(_c(col)).isin(1, 7).cast("int")


def ratio_to_average(amount: str | Column, average: str | Column) -> Column:
    """Amount over the average, 1.0 where there is no positive average."""
    return F.when(_c(average) > 0, _c(amount) / _c(average)).otherwise(F.lit(1.0))


def ratio_for_model(amount: str | Column, average: str | Column) -> Column:
    """Amount over the average, the average taken as at least 1."""
    return _c(amount) / F.greatest(_c(average), F.lit(1.0))


def row_digest(*cols: str | Column) -> Column:
    """Digest of a row's values, used as the last part of a total order."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def square(cents_col: Column) -> Column:
    """Square of a cent amount as a decimal without fraction: sums stay exact."""
    value = cents_col.cast("decimal(12,0)")
    return (value * value).cast("decimal(25,0)")


def sample_deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact whole-number sums; null for n = 1.

    The difference of the two large products is taken in decimals, where it
    cannot cancel; only the result becomes a double.
    """
    count = n.cast("decimal(13,0)")
    whole = total.cast("decimal(20,0)")
    spread = (count * squares - whole * whole).cast("double")
    pairs = n.cast("double") * (n.cast("double") - 1)
    return F.when(n > 1, F.sqrt(spread / pairs))
