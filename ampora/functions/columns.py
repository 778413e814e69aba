"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "year_month_of_date", "month_start", "nan_to_null",
    "is_object", "is_present", "json_field", "json_field_or", "array_field", "uncastable", "json_text",
    "safe_pearson", "round6", "ts_text",
]


def year_month_of_date(value: Column) -> Column:
    """``yyyy-MM`` of a date-like value (string, date or timestamp)."""
    return F.date_format(F.to_date(value), "yyyy-MM")


def month_start(year_month: Column) -> Column:
    """``yyyy-MM`` -> first day of that month as DATE."""
    return F.to_date(F.concat(year_month, F.lit("-01")))


def nan_to_null(c: Column) -> Column:
    """Spark keeps NaN as a value (mean = NaN); pandas treats it as missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def is_object(v: Column, path: str = "$") -> Column:
    """True when the VARIANT value at ``path`` is a JSON object.

    A cast to the empty struct succeeds for any object and fails for every
    other kind, without walking the value (``schema_of_variant`` would
    infer the schema of the whole document).
    """
    return F.try_variant_get(v, path, "struct<>").isNotNull()


def is_present(v: Column, path: str) -> Column:
    """True when the member exists (an explicit JSON null counts)."""
    return F.try_variant_get(v, path, "variant").isNotNull()


def json_field(v: Column, path: str, type_: str) -> Column:
    """Typed member lookup; missing, JSON null or uncastable gives NULL."""
    return F.try_variant_get(v, path, type_)


def json_field_or(v: Column, path: str, type_: str, default: Column) -> Column:
    """``dict.get(key, default)``: default only when the member is *absent*.

    An explicit JSON null stays NULL (the reference would print ``None``).  The member is only copied, to see whether it
    is there, where it has no value.
    """
    return F.coalesce(F.try_variant_get(v, path, type_), F.when(~is_present(v, path), default))


def array_field(v: Column, path: str) -> Column:
    """Member as ``array<variant>``; NULL when absent or not an array."""
    return F.try_variant_get(v, path, "array<variant>")


def uncastable(v: Column, path: str, type_: str) -> Column:
    """True when the member is there, is not JSON null, and is no value of the numeric type.

    ``json_field`` gives NULL for all three of absent, null and uncastable.  Text that reads as a number is
    one and blank text is NULL, as in a CSV load; a boolean is none, and a fraction is no whole number.
    """
    raw = F.try_variant_get(v, path, "variant")
    text = F.coalesce(F.try_variant_get(v, path, "string"), F.lit("-"))     # objects and arrays have no text
    bad = F.try_variant_get(v, path, type_).isNull() | text.isin("true", "false")
    if type_ == "bigint":
        number = F.try_variant_get(v, path, "double")
        bad = bad | (number != F.floor(number))
    # the copy of the member is last: it is only made where the number is in doubt
    return F.coalesce(bad & (text != "") & raw.isNotNull() & ~F.is_variant_null(raw), F.lit(False))


def json_text(v: Column, path: str = "$") -> Column:
    """The member as JSON text, for messages."""
    return F.to_json(F.try_variant_get(v, path, "variant"))


def safe_pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson correlation that never raises.

    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI; this
    form returns NULL for constant columns and for fewer than two pairs.
    """
    xp = F.when(y.isNotNull(), x)
    yp = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(xp) * F.stddev_samp(yp))


def round6(c: Column) -> Column:
    return F.round(c, 6)


def ts_text(c: Column) -> Column:
    """Timestamp rendered as text in the session zone (UTC)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
