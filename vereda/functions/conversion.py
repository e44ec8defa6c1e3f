"""Text to number, date and path parts, with null for what does not parse."""

from pyspark.sql import Column, functions as F

_DIGITS = "[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_INFINITY = r"^[+-]?(?i:inf|infinity)$"
_NAN = r"^[+-]?(?i:nan)$"
_BLANK = " \t\n\r\x0b\x0c"


def decimal_comma_double(text: Column) -> Column:
    """Double from text that may use a decimal comma."""
    clean = F.translate(F.trim(text, F.lit(_BLANK)), ",", ".")
    number = F.translate(clean, "_", "").try_cast("double")
    return (
        F.when(clean.rlike(_NUMBER), number)
        .when(clean.rlike(_NAN), F.lit(float("nan")))
        .when(clean.rlike(_INFINITY), number)
    )


def day_first_date(text: Column) -> Column:
    """Date from ``dd/MM/yyyy`` text."""
    return F.try_to_date(text, "dd/MM/yyyy")


def source_from_path(path: Column) -> Column:
    """Value of the first ``fonte=`` segment of a path, null where there is none."""
    return F.nullif(F.regexp_extract(path, r"(?:^|/)fonte=([^/=]*)", 1), F.lit(""))
