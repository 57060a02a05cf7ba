"""Value cleaning as pure Catalyst expressions (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What each market keeps of a national id and how long it may be.
NATIONAL_ID_RULES = {
    "SE": ("[^0-9]", 12, False),
    "NO": ("[^0-9]", 11, False),
    "DK": ("[^0-9]", 10, False),
    "FI": ("[^0-9-+A-Z]", 11, True),
}
# Country calling codes.
CALLING_CODES = {"SE": "46", "DK": "45", "NO": "47", "FI": "358"}
# Placeholders found in source data.
ZERO_DATE = "0000-00-00 00:00:00"
ZERO_DATE_REPLACEMENT = "1900-01-01 00:00:00"
ANONYMISED_WORD = "anonymized"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _per_market(market: Column | str, branches: dict[str, Column], otherwise: Column) -> Column:
    """Choose a branch by market; a literal market costs nothing at run time."""
    if isinstance(market, str):
        return branches.get(market, otherwise)
    chosen = F
    for code, branch in branches.items():
        chosen = chosen.when(market == code, branch)
    return chosen.otherwise(otherwise)


def national_id(
    value: Column,
    market: Column | str,
    zero_to_null: bool = False,
    fallback_digits: bool = False,
) -> Column:
    """Normalise a national id by market; other markets give NULL (or digits only)."""
    text = value.cast("string")

    def keep(pattern: str, length: int, upper: bool) -> Column:
        source = F.upper(text) if upper else text
        return F.left(F.regexp_replace(source, pattern, ""), F.lit(length))

    digits = F.regexp_replace(text, "[^0-9]", "")
    otherwise = digits if fallback_digits else F.lit(None).cast("string")
    cleaned = _per_market(market, {m: keep(*rule) for m, rule in NATIONAL_ID_RULES.items()}, otherwise)
    if zero_to_null:
        is_zero = F.coalesce(text.try_cast("bigint") == 0, F.lit(False))
        cleaned = F.when(~is_zero, cleaned)
    return cleaned


def phone(value: Column, market: Column | str) -> Column:
    """Bring a phone number to international form by market; unusable numbers give NULL."""
    digits = F.regexp_replace(value, r"[^0-9\s]", "")
    size = F.length(digits)

    def plus(text: Column) -> Column:
        return F.concat(F.lit("+"), text)

    def tail(text: Column, start: int) -> Column:
        return F.substring(text, start, 2_000_000)

    def local(code: str, text: Column) -> Column:
        return F.concat(F.lit("+" + code), text)

    fi = CALLING_CODES["FI"]
    finnish = (
        F.when(value.startswith(fi), F.when(size.between(9, 15), plus(digits)))
        .when(value.startswith("0"), F.when(size.between(7, 13), local(fi, tail(digits, 2))))
        .when(size.between(6, 12), local(fi, digits))
    )

    def nordic(code: str) -> Column:
        return (
            F.when(value.startswith(code), plus(value))
            .when(value.startswith("0" + code), plus(tail(value, 2)))
            .when(value.startswith("00" + code), plus(tail(value, 3)))
            .when(value.startswith("0"), local(code, tail(value, 2)))
            .otherwise(local(code, value))
        )

    no = CALLING_CODES["NO"]
    norwegian = (
        F.when(value.startswith(no), F.when(size == 10, plus(digits)))
        .when(value.startswith("0" + no) & (size == 11), plus(tail(digits, 2)))
        .when(value.startswith("00" + no) & (size == 12), plus(tail(digits, 3)))
        .when(value.startswith("0"), F.when(size == 9, local(no, tail(digits, 2))))
        .when(size == 8, local(no, digits))
    )
    domestic = _per_market(
        market,
        {
            "FI": finnish,
            "SE": nordic(CALLING_CODES["SE"]),
            "DK": nordic(CALLING_CODES["DK"]),
            "NO": norwegian,
        },
        F.lit(None).cast("string"),
    )
    compact = F.replace(value, F.lit(" "), F.lit(""))
    international = F.when((F.length(compact) > 6) & (F.length(compact) < 18), compact)
    return (
        F.when(value.startswith(" +"), tail(value, 2))
        .when(~value.contains("+"), domestic)
        .otherwise(international)
    )


def flag_is_one(value: Column) -> Column:
    """'1' is true, anything else (NULL too) is false."""
    return F.coalesce(value == "1", F.lit(False))


def flag_not_zero(value: Column) -> Column:
    """'0' is false, anything else (NULL too) is true."""
    return F.coalesce(value != "0", F.lit(True))


def flag_not_zero_or_null(value: Column) -> Column:
    """'0' and NULL are false, anything else is true."""
    return F.coalesce(value != "0", F.lit(False))


def zero_date(value: Column, replacement: str | None = None) -> Column:
    """Replace the all-zero timestamp text before it is cast."""
    return F.when(value == ZERO_DATE, F.lit(replacement).cast("string")).otherwise(value)


def default_value(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def click_id(url: Column, param: str) -> Column:
    """Value of a tracking parameter: NULL when absent, '' when present but empty."""
    return F.when(url.contains(param + "="), F.regexp_extract(url, param + "=([^&]*)", 1))


def brand(domain: Column, needle: str, name: str, otherwise: str) -> Column:
    """Brand by substring of the domain; a missing domain falls to the default brand."""
    return F.when(domain.contains(needle), F.lit(name)).otherwise(F.lit(otherwise))


def date_from_path(path: Column, segments: tuple[int, int, int] = (4, 5, 6)) -> Column:
    """Date from three zero-based '/' segments of a file path."""
    parts = F.split(path, "/")
    return F.concat_ws("-", *[parts.getItem(i) for i in segments]).cast("date")


def date_from_path_pattern(path: Column) -> Column:
    """Date from the first year/month/day run found in a file path."""
    return F.to_date(F.regexp_extract(path, "[0-9]{2,}/[0-9]+/[0-9]+", 0), "yyyy/M/d")


def not_blank(value: Column, dtype: T.DataType) -> Column:
    """Type-aware emptiness: numbers must differ from 0, everything else from ''."""
    filled = value != 0 if isinstance(dtype, NUMERIC_TYPES) else value.cast("string") != ""
    return value.isNotNull() & filled


def blank(value: Column, dtype: T.DataType) -> Column:
    """True for NULL, '' (text) or 0 (numbers)."""
    return ~F.coalesce(not_blank(value, dtype), F.lit(False))


def safe_timestamp(value: Column) -> Column:
    """Timestamp of a text that starts with a full date, else NULL (a bare year is no timestamp)."""
    return F.when(value.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), value.try_cast("timestamp"))


def epoch_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))


def name_key(name: Column) -> Column:
    """Comparable column name: lower case without underscores."""
    return F.lower(F.replace(name, F.lit("_"), F.lit("")))


def path_name_key(path: Column) -> Column:
    """Comparable name of a field path: the first segment is dropped when nested."""
    dot = F.instr(path, ".")
    nested = F.substring(path, dot + 1, F.length(path))
    return name_key(F.when(dot > 0, nested).otherwise(path))


def last_segment(resource: Column, separator: str = "/") -> Column:
    """Trailing part of a resource id."""
    return F.substring_index(resource, separator, -1)
