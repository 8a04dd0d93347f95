"""Column expressions whose Spark defaults differ from what the cleaning rules need.

Every helper takes and returns a ``Column``; all of them stay in generated JVM code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a number may be made of, with blanks around them. ``try_cast`` decides
# about the rest; alone it would also read type suffixes ('1d', '2f'), hexadecimal floats and 'nan'.
NUMBER_PATTERN = r"^[ \t\r\n]*[+-]?(?:[0-9.][0-9.eE+-]*|(?i:inf(?:inity)?))[ \t\r\n]*$"

# Fixed value: year, month and day separated by dashes and nothing else.
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"

BLANKS = " \t\r\n"


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.trim(_as_column(c), F.lit(BLANKS))


def nan_to_null(c: Column | str) -> Column:
    c = _as_column(c).cast("double")
    return F.when(~F.isnan(c), c)


def number_or_null(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    One short expression per cell, so a projection over many columns stays small enough for the JVM
    to compile; the pattern also keeps most failing casts (an exception each) from happening.
    """
    text = _as_column(c).cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def date_or_null(c: Column | str) -> Column:
    """Blank-padded ``yyyy-M-d`` text to a date; impossible or longer texts become NULL."""
    text = strip(c)
    return F.when(text.rlike(DATE_PATTERN), F.try_to_date(text, "yyyy-M-d"))


def to_long_half_even(c: Column | str) -> Column:
    return F.rint(_as_column(c).cast("double")).cast("bigint")


def is_one_of(c: Column | str, valid: Iterable) -> Column:
    """Membership where NULL is simply not a member."""
    return F.coalesce(_as_column(c).isin(list(valid)), F.lit(False))


def clamp(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip into [lo, hi]. ``least``/``greatest`` skip NULL, so NULL is guarded."""
    c = _as_column(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo).cast("double"))
    if hi is not None:
        out = F.least(out, F.lit(hi).cast("double"))
    return F.when(c.isNotNull(), out)


def text_or_nan(c: Column | str) -> Column:
    """Text form used by the category drift tests, where a missing value is the text 'nan'."""
    return F.coalesce(_as_column(c).cast("string"), F.lit("nan"))


def flag(condition: Column) -> Column:
    """Boolean to 0/1 with NULL counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_as_column(c), "/"), -1)


def stem(c: Column | str) -> Column:
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*$", "")


def epoch_ms_to_utc(c: Column | str) -> Column:
    """Milliseconds since the epoch to a zone-free UTC timestamp."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ms = _as_column(c)
    seconds = ms.cast("decimal(20,3)") / F.lit(1000).cast("decimal(5,0)")
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def two_parts(c: Column | str, separator: str = ":") -> tuple[Column, Column, Column]:
    """(left, right, well_formed) for ids that must have exactly one separator."""
    parts = F.split(_as_column(c), separator)
    ok = F.coalesce(F.size(parts) == 2, F.lit(False))
    return F.when(ok, F.get(parts, F.lit(0))), F.when(ok, F.get(parts, F.lit(1))), ok


def inner_lengths(c: Column | str) -> Column:
    """Distinct, sorted lengths of the inner arrays of an array of arrays."""
    return F.array_sort(F.array_distinct(F.transform(_as_column(c), lambda row: F.size(row))))


#: Values that ``hash_fraction`` can take.
HASH_PRIME = 1000003


def hash_fraction(key: Column | str, seed: int) -> Column:
    """A number in [0, 1) that depends on the integer key and the seed only.

    Plain integer arithmetic modulo a prime: the same row gets the same number whatever the
    partitioning, and any SQL engine computes the same one. For text keys pass ``xxhash64(key)``.
    """
    prime = F.lit(HASH_PRIME).cast("bigint")
    k = F.pmod(_as_column(key).cast("bigint"), F.lit(4294967296).cast("bigint"))
    m = F.pmod(k * 40503 + F.floor(k / 65536) * 2654435 + seed * 7919, prime)
    return F.pmod(m * m + m * 65599 + seed, prime) / float(HASH_PRIME)
