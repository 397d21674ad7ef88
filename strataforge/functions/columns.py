"""Column helpers. All are plain expressions, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_range(value: Column, low, high) -> Column:
    """value where low <= value <= high, else null."""
    return F.when(value.between(low, high), value)


def null_if_longer(value: Column, limit: int) -> Column:
    return F.when(F.length(value) <= limit, value)


def safe_int(text: Column) -> Column:
    """Text to whole number, rounded half away from zero over six decimals; null where it is no number or too large.

    Plain whole numbers, nearly all of them, are cast at once. The way over decimals is a lambda, whose code stays out of
    what is generated for a row: written out for each column of a wide table it makes methods too large for the JIT.
    """
    plain = F.when(~(F.contains(text, F.lit(".")) | F.contains(text, F.lit("\x7f"))), text.try_cast("bigint"))  # the cast trims DEL, decimals don't
    return F.coalesce(plain, F.get(F.transform(F.array(text), lambda t: F.round(t.try_cast("decimal(38,6)"), 0).try_cast("bigint")), F.lit(0)))


def strict_greatest(*values: Column) -> Column:
    """Greatest value, null if any is null."""
    return F.when(reduce(lambda a, b: a & b, [v.isNotNull() for v in values]), F.greatest(*values))


def strict_least(*values: Column) -> Column:
    """Least value, null if any is null."""
    return F.when(reduce(lambda a, b: a & b, [v.isNotNull() for v in values]), F.least(*values))


def title_case(text: Column) -> Column:
    """First letter of every run of letters, digits and apostrophes in upper case, the rest in lower case."""
    parts = F.regexp_extract_all(F.lower(text), F.lit("([\\p{L}\\p{N}']+|[^\\p{L}\\p{N}']+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")


def words_of_pascal(text: Column) -> Column:
    """TwistedFate to Twisted Fate, in title case."""
    return title_case(F.trim(F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2")))


def parse_timestamp(text: Column) -> Column:
    """ISO text, or an epoch in digits: seconds, milliseconds, microseconds or nanoseconds by size. Else null."""
    number = F.when(text.rlike("^-?[0-9]{1,20}$"), text.try_cast("decimal(38,0)"))
    size = F.abs(number)
    micros = (
        F.when(size < 31536000000, number * 1000000).when(size < 31536000000000, number * 1000).when(size < 31536000000000000, number).otherwise(F.floor(number / 1000))
    )
    epoch = F.timestamp_micros(micros.try_cast("bigint")).cast("timestamp_ntz")
    return F.when(number.isNotNull(), epoch).otherwise(text.try_cast("timestamp_ntz"))


def stamp_in_name(file_name: Column) -> Column:
    """The day that a file name carries as `_yyyyMMdd.`, strictly; null where there is none or it is no date."""
    digits = F.regexp_extract(file_name, "_([0-9]{8})\\.", 1)
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("timestamp_ntz")


def fast_hash(text: Column) -> Column:
    """20-byte digest of the trimmed upper-case text."""
    return F.unhex(F.sha1(F.upper(F.trim(text))))


def joined(values: list[Column], separator: str = "^") -> Column:
    """Values as text with a separator; a null is an empty slot, so that neighbours never run together."""
    return F.array_join(F.array(*[v.cast("string") for v in values]), separator, "")


def boundaries_between(unit: str, start: Column, end: Column) -> Column:
    """How many boundaries of the unit (minute or second) lie between two timestamps."""
    seconds = {"minute": 60, "second": 1}[unit]
    at = lambda c: F.unix_micros(F.date_trunc(unit, c.cast("timestamp")))
    return F.floor((at(end) - at(start)) / (seconds * 1000000)).cast("bigint")


def decimal_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded half up in decimal arithmetic, as a double; null for a zero denominator."""
    exact = numerator.cast("decimal(20,0)") / F.nullif(denominator, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, digits).cast("double")


def decimal_mean(values: Column, digits: int) -> Column:
    """Mean of whole numbers, rounded half up in decimal arithmetic, as a double."""
    return decimal_ratio(F.sum(values), F.count(values), digits)
