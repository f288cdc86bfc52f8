"""Scalar column builders (``Column -> Column``).

Every function returns a plain Catalyst expression, so it stays inside
whole-stage codegen; none of them calls Python per row.  Multi-step
regex chains of the source system are folded into the single pattern
that gives the same result (one pass over the string instead of four).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Patterns whose matches must equal the source system's.
# (?U) makes \d, \w and \s Unicode-aware, as they are in the source regexes.
NON_DIGITS = r"(?U)\D+"
NOT_PART_CHAR = r"(?U)[^\w-]"
RACK_PATTERN = r"(?U)P\d+[A-Z]?"
TAKT_PATTERN = r"(?U)T\d+"
LANE_PREFIX = "lane_"
RECEPTION = "reception"
# Whole-string float literal (NaN / inf spellings included); Spark's own cast
# would also take the Java suffixes "d"/"f", which the source does not.
FLOAT_LITERAL = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"
DATE_FORMAT = "dd.MM.yyyy"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    """cast to string."""
    return _col(c).cast(T.StringType())


def box_count(c: ColumnOrName) -> Column:
    """keep the digits of e.g. ``MAX: 12`` as bigint; unparsable or null -> 0."""
    digits = F.regexp_replace(as_text(c), NON_DIGITS, "")
    return F.coalesce(digits.try_cast(T.LongType()), F.lit(0).cast(T.LongType()))


def part_number(c: ColumnOrName) -> Column:
    """drop everything except word characters and '-', then upper-case."""
    return F.upper(F.regexp_replace(as_text(c), NOT_PART_CHAR, ""))


def first_match(c: ColumnOrName, pattern: str) -> Column:
    """First regex match anywhere in the string; NULL when there is none."""
    return F.regexp_substr(_col(c), F.lit(pattern))


def rack(c: ColumnOrName) -> Column:
    """rack code ``P<digits>[A-Z]``."""
    return first_match(c, RACK_PATTERN)


def takt(c: ColumnOrName) -> Column:
    """station code ``T<digits>``."""
    return first_match(c, TAKT_PATTERN)


def without_spaces(c: ColumnOrName) -> Column:
    """F5 for one column: remove every ASCII space."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def strip_string_columns(df: DataFrame) -> DataFrame:
    """remove ASCII spaces from every string column, in one projection."""
    targets = {f.name: without_spaces(F.col(f"`{f.name}`"))
               for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(targets) if targets else df


def lenient_double(c: ColumnOrName) -> Column:
    """float parse, NULL when the text is not a float literal."""
    text = as_text(c)
    return F.when(text.rlike(FLOAT_LITERAL), text.try_cast(T.DoubleType()))


def lenient_int(c: ColumnOrName, default: int = 0) -> Column:
    """F7 + F8: 32-bit int parse, ``default`` when unparsable or null.

    A text without a digit is no number and is not tried: a failing cast
    costs far more than a successful one.
    """
    text = as_text(c)
    return F.coalesce(F.when(text.rlike("[0-9]"), text.try_cast(T.IntegerType())), F.lit(default))


def fill_null(c: ColumnOrName, value) -> Column:
    """F8."""
    return F.coalesce(_col(c), F.lit(value))


def remove_first(c: ColumnOrName, literal: str) -> Column:
    """drop the first occurrence of ``literal`` anywhere in the string."""
    quoted = "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.regexp_replace(_col(c), "(?s)^(.*?)" + quoted, "$1")


def car_key(werk: ColumnOrName, spj: ColumnOrName, knr: ColumnOrName) -> Column:
    """``werk || spj || knr``; NULL if any part is NULL."""
    return F.concat(as_text(werk), as_text(spj), as_text(knr))


def floor_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """F12 over a true division; a zero or NULL denominator gives NULL."""
    ratio = F.try_divide(_col(num).cast(T.DoubleType()), _col(den).cast(T.DoubleType()))
    return F.floor(ratio).cast(T.LongType())


def is_blank(c: ColumnOrName) -> Column:
    """NULL or only white space, of any script (tab, no-break space and so on)."""
    return F.coalesce(~_col(c).rlike(r"(?U)\S"), F.lit(True))


def contains_ci(c: ColumnOrName, needle: str) -> Column:
    """case-insensitive substring test."""
    return F.lower(_col(c)).contains(needle.lower())


def day_text(d: ColumnOrName) -> Column:
    """date as ``dd.MM.yyyy``."""
    return F.date_format(_col(d), DATE_FORMAT)


def parse_day(c: ColumnOrName) -> Column:
    """F15 inverse: ``dd.MM.yyyy`` text to date (NULL when malformed)."""
    return F.try_to_timestamp(_col(c), F.lit(DATE_FORMAT)).cast(T.DateType())
