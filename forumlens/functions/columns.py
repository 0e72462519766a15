"""Column helpers: all built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_text(ts: ColumnLike) -> Column:
    """Year of a timestamp as four-digit text (``STRFTIME('%Y', ts)``)."""
    return F.date_format(_c(ts), "yyyy")


def year_prefix(text: ColumnLike) -> Column:
    """First four characters of ISO date text (``substr(x, 1, 4)``)."""
    return F.substring(_c(text), 1, 4)


def age_class(year: ColumnLike, new_years: Iterable[str] = ("2016", "2017")) -> Column:
    """Simple CASE: a year in ``new_years`` is 'new', anything else 'old'.

    A missing year falls to the ELSE branch and is 'old', as in SQL.
    """
    return F.when(_c(year).isin(list(new_years)), F.lit("new")).otherwise(F.lit("old"))


def age_threshold(year: ColumnLike, threshold: str = "2016") -> Column:
    """Text threshold: year text >= threshold is 'new', below it 'old'.

    Unlike :func:`age_class`, later years are 'new' and a missing year stays
    missing (it belongs to neither class).
    """
    y = _c(year).cast("string")
    return F.when(y >= threshold, F.lit("new")).when(y < threshold, F.lit("old"))


def case_value(cond: Column, value: ColumnLike, otherwise=0) -> Column:
    """Searched CASE: ``value`` where ``cond`` holds, else ``otherwise``."""
    return F.when(cond, _c(value)).otherwise(F.lit(otherwise))


def pad_left(value: ColumnLike, width: int = 2, pad: str = "0") -> Column:
    """Left pad to ``width``; longer text is kept whole (Spark's lpad would cut it)."""
    text = _c(value).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, pad))


def month_key(year: ColumnLike, month: ColumnLike) -> Column:
    """'YYYY-MM' text key; sorts chronologically thanks to the padding.
    Missing year or month gives a missing key (``concat`` propagates NULL,
    where ``concat_ws`` would silently drop the part), as does a month
    outside 1..12."""
    month = F.when(_c(month).cast("string").try_cast("int").between(1, 12), _c(month))
    return F.concat(_c(year).cast("string"), F.lit("-"), pad_left(month, 2, "0"))


def is_missing(c: ColumnLike) -> Column:
    return _c(c).isNull()


def fill_missing(c: ColumnLike, value=0) -> Column:
    return F.coalesce(_c(c), F.lit(value))


def fill_columns(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    """Replace missing values of the named columns (NA -> 0)."""
    return df.na.fill(value, list(cols))


def fill_all(df: DataFrame, number=0, text: str | None = "0", boolean: bool | None = False,
             day: str | None = "1970-01-01", time: str | None = "1970-01-01 00:00:00") -> DataFrame:
    """Replace every missing value by what 0 is in its column's type: numbers by ``number``, text
    by ``text``, truth values, dates and timestamps by ``boolean``, ``day`` and ``time``. None leaves that type as it is.

    ``na.fill(0)`` alone leaves all but numbers missing; the reference's whole-frame fill
    rewrote every column. Nested and binary columns have no 0 and stay.
    """
    def filled(f: T.StructField) -> Column:
        kind, c = f.dataType, F.col(f"`{f.name}`")
        value = (number if isinstance(kind, T.NumericType) else text if isinstance(kind, T.StringType)
                 else boolean if isinstance(kind, T.BooleanType) else day if isinstance(kind, T.DateType)
                 else time if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else None)
        if value is None:
            return c
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            c = F.nanvl(c, F.lit(None).cast(kind))
        return F.coalesce(c, F.lit(value).cast(kind)).alias(f.name)

    return df.select(*(filled(f) for f in df.schema.fields))


def null_safe_eq(a: ColumnLike, b: ColumnLike) -> Column:
    """Equality where missing equals missing (``<=>``)."""
    return _c(a).eqNullSafe(_c(b))
