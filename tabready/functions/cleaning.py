"""Column-level cleaning and parsing.

Every function returns a ``Column`` built from Spark built-ins, so the work
stays inside whole-stage codegen and runs unchanged on streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference workflow's behaviour.
# Text that counts as missing after stripping (exact, case-sensitive match for
# numbers; categoricals are lower-cased first).
NULL_TOKENS: tuple[str, ...] = ("", "nan", "none", "null")
# A clock duration: digits, then one or two groups of ":" and one or two digits.
CLOCK_PATTERN = r"^\d+(:\d{1,2}){1,2}$"
# A plain decimal number with optional sign and exponent.  Text outside this
# pattern (``10d``, ``1_000``, ``inf``) is missing, identically in Spark and SQL.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# White space that is removed from both ends.
EDGE_SPACE = " \t\n\x0b\f\r"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove surrounding whitespace of any kind."""
    return F.btrim(_col(c), F.lit(EDGE_SPACE))


def nan_to_null(c: str | Column) -> Column:
    """Floating NaN becomes NULL, so aggregates treat it as missing (H1)."""
    c = _col(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL and -0.0 as 0.0 where it is floating (H1)."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        c = F.col(f"`{name}`")
        return F.when(~F.isnan(c), c + F.lit(0.0).cast(df.schema[name].dataType))
    return F.col(f"`{name}`")


def safe_float(c: str | Column) -> Column:
    """Anything non-numeric or NaN becomes NULL."""
    return nan_to_null(_col(c).try_cast("double"))


def _null_tokens(text: Column, tokens: Sequence[str]) -> Column:
    return F.when(~text.isin(*tokens), text)


def parse_number_text(c: str | Column, null_tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Stripped text with thousands separators removed, to double or NULL."""
    text = _null_tokens(strip(c), null_tokens)
    digits = F.regexp_replace(text, ",", "")
    return F.when(digits.rlike(NUMBER_PATTERN), digits.try_cast("double"))


def clock_to_seconds(c: str | Column) -> Column:
    """P5: ``M:S`` -> m*60+s, ``H:M:S`` -> h*3600+m*60+s, otherwise NULL.

    Minutes and seconds are not range-checked (``4:75`` is 315 seconds).
    """
    parts = F.split(_col(c), ":")
    p = [parts.getItem(i).try_cast("double") for i in range(3)]
    n = F.size(parts)
    return F.when(n == 2, p[0] * 60 + p[1]).when(n == 3, p[0] * 3600 + p[1] * 60 + p[2])


def parse_numeric_or_time(
    c: str | Column, is_numeric: bool = False, null_tokens: Sequence[str] = NULL_TOKENS
) -> Column:
    """Numbers pass through; text is stripped, null tokens and commas removed,
    clock durations converted to seconds, anything else unparsable is NULL."""
    if is_numeric:
        return nan_to_null(c)
    text = _null_tokens(strip(c), null_tokens)
    return F.when(text.rlike(CLOCK_PATTERN), clock_to_seconds(text)).otherwise(
        parse_number_text(text, null_tokens)
    )


def clean_categorical(c: str | Column, null_tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Strip + lower-case; null tokens become NULL, other placeholders stay."""
    return _null_tokens(F.lower(strip(_col(c).cast("string"))), null_tokens)


def null_out_of_range(c: str | Column, minimum: float | None = None, maximum: float | None = None) -> Column:
    """Values outside the inclusive range become NULL; either bound optional."""
    c = _col(c)
    keep = F.lit(True)
    if minimum is not None:
        keep = keep & (c >= F.lit(minimum))
    if maximum is not None:
        keep = keep & (c <= F.lit(maximum))
    return F.when(keep, c)


def null_non_positive(c: str | Column) -> Column:
    """Values ``<= 0`` become NULL."""
    c = _col(c)
    return F.when(c > 0, c)


def null_sentinels(c: str | Column, sentinels: Iterable[float]) -> Column:
    """Sentinel values become NULL."""
    c = _col(c)
    return F.when(~c.isin(*list(sentinels)), c)


def is_sentinel(c: str | Column, sentinels: Iterable[float]) -> Column:
    """True where the value is one of the sentinels (for ``count_if``)."""
    return F.coalesce(_col(c).isin(*list(sentinels)), F.lit(False))
