"""Text to typed values, bad text to NULL (never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.schemas import EVENT_TIME_FORMAT, TXT_DATETIME_FORMAT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def na(c, markers=("?", "")) -> Column:
    """NA markers (``?`` and empty, after trimming) become NULL."""
    c = F.trim(_c(c))
    return F.when(c.isin(*markers), F.lit(None).cast("string")).otherwise(c)


NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def to_number(c, finite: bool = False) -> Column:
    """Numeric coercion: text that is no number becomes NULL (ANSI-safe).

    Suffixes that a cast alone would take (``1.5d``) are no numbers; NaN and
    the infinities are, unless ``finite``.
    """
    c = _c(c)
    x = F.when(c.rlike(NUMBER), c.try_cast("double"))
    return F.when(F.abs(x) < F.lit(float("inf")), x) if finite else x


def parse_event_time(c, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to timestamp; bad text to NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_day_first(date, time, fmt: str = TXT_DATETIME_FORMAT) -> Column:
    """Day-first ``d/M/yyyy`` + ``H:mm:ss`` to timestamp; bad text to NULL."""
    return F.try_to_timestamp(F.concat_ws(" ", _c(date), _c(time)), F.lit(fmt))


def round_half_even(c, digits: int) -> Column:
    """``c`` rounded to ``digits`` decimals by the exact value of the double, ties to even.

    The product with 10**digits is split into its double and the exact rest
    (the factor has few enough bits), so 2.675 goes to 2.67, as its double is
    a little less. NaN, infinities and numbers beyond 2**52 stay as they are.
    """
    c, scale = _c(c), float(10**digits)
    big = F.lit(134217729.0) * c
    high = big - (big - c)
    product = c * F.lit(scale)
    rest = (high * F.lit(scale) - product) + (c - high) * F.lit(scale)
    down = F.floor(product).cast("double")
    over = (product - down) - F.lit(0.5)  # exact; the rest decides where it is zero
    up, tie = over + rest > 0, over + rest == 0
    n = F.when(up, down + 1).when(tie & (F.pmod(down, F.lit(2.0)) == 1), down + 1).otherwise(down)
    return F.when(F.abs(product) < F.lit(2.0**52), n / F.lit(scale)).otherwise(c)
