"""Number parsing and unit expressions. Built-in expressions only, no Python UDF.

Three rules for bad input stay apart on purpose: ``num_strict`` gives NULL (the row
is later dropped), ``num_zero`` gives 0, ``num_prefix`` reads a leading number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as decimal text, and the spelled-out specials. Spark's own
# cast is looser (it takes "1.0d" and " 3 "), so the cast is guarded by these patterns.
FINITE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
SPECIAL = r"^(?i)([+-]?inf(inity)?|nan)\z"
NUMBER = f"{FINITE}|{SPECIAL}"
PREFIX = (
    r"^((?i)[+-]?inf|nan|[+-]?[0-9_]*(\.[0-9_]*)?([e][+-]?[0-9_]*)?)"
)
# Variant types that hold a JSON number.
JSON_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(.*\))$"

SPACE = " \t\n\v\f\r\u0085 "
INF = float("inf")


def trim_ws(text: Column) -> Column:
    """Trim white space of every kind, not only blanks."""
    return F.btrim(text, F.lit(SPACE))


def as_number(text: Column) -> Column:
    """Number, infinity when out of range, NULL when the text is no number."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def drop_out_of_range(number: Column, text: Column) -> Column:
    """NULL for an infinity that came from a finite literal."""
    return F.when((F.abs(number) < INF) | text.rlike(SPECIAL), number)


def num_strict(text: Column) -> Column:
    """Number or NULL; a finite literal too large for a double is NULL too."""
    return drop_out_of_range(as_number(text), text)


def num_zero(text: Column) -> Column:
    """Number, 0 when the text is not one, infinity when it is out of range."""
    return F.coalesce(as_number(text), F.lit(0.0))


def num_prefix(text: Column) -> Column:
    """Leading number of the text, 0 when there is none."""
    token = F.regexp_extract(trim_ws(text), PREFIX, 1)
    return F.coalesce(num_strict(token), F.lit(0.0))


def num_json(value: Column) -> Column:
    """Double of a variant that holds a JSON number; NULL for text, booleans and the rest."""
    return F.when(
        F.schema_of_variant(value).rlike(JSON_NUMBER), F.try_variant_get(value, "$", "double")
    )


def zero(value: Column) -> Column:
    """Absent JSON number as 0."""
    return F.coalesce(value.cast("double"), F.lit(0.0))


def bool01(flag: Column) -> Column:
    """True as 1, false or absent as 0."""
    return F.coalesce(flag.cast("double"), F.lit(0.0))


def enum_code(label: Column, codes: dict[str, float], default: float) -> Column:
    """Numeric code of a label."""
    code = F.lit(float(default))
    for text, number in codes.items():
        code = F.when(label == text, F.lit(float(number))).otherwise(code)
    return code


# Unit conversions applied to source readings.
FACTORS = {"us_to_ms": 0.001, "kb_to_bytes": 1024.0, "ratio_to_percent": 100.0}


def convert(value: Column, kind: str) -> Column:
    """Multiply by the named unit factor."""
    return value.cast("double") * F.lit(FACTORS[kind])


def kib_to_pages(kib: Column, page_size: Column) -> Column:
    """Whole pages in a KiB amount; NULL when the page size is not positive."""
    size = F.when(page_size > 0, page_size)
    total = kib.cast("bigint") * 1024
    return ((total - total % size) / size).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone is."""
    since = ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("decimal(20,6)") * 1000000).cast("bigint")


def lag_seconds(ahead: Column, behind: Column) -> Column:
    """Seconds by which one timestamp leads another, never below 0."""
    return F.greatest(F.lit(0.0), (micros(ahead) - micros(behind)) / F.lit(1e6))


def ratio(num: Column, den: Column, on_zero: str = "omit") -> Column:
    """``num / den`` where ``den`` is positive, else 0 (``zero``) or NULL (``omit``)."""
    other = {"zero": F.lit(0.0), "omit": F.lit(None).cast("double")}[on_zero]
    safe = F.when(den > 0, den.cast("double"))
    return F.coalesce(num.cast("double") / safe, other)
