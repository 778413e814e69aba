"""Nested documents -> flat rows, with VARIANT expressions.

``from_json`` with a fixed schema turns a whole array NULL when one item has
the wrong shape; the original skips only that item.  Parsing to VARIANT and
exploding ``array<variant>`` keeps item-level skipping.  All work is per row
(Project + Generate), no shuffle.

Plan shape matters here: each document is parsed once (see ``parsed``),
and every check reads the parsed value.  Validation errors are
raised from the *generator input* rather than from a filter -- a filter
would be pushed below the parse projection and re-parse the text once per
referenced field.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampora.constants import BALANCE_ENDPOINT, BALANCE_SOURCE, DAILY_SERIES
from ampora.functions.columns import (array_field, is_object, is_present, json_field,
                                      json_field_or, json_text, uncastable)
from ampora.schemas import BALANCE_FLAT, WEATHER_DAILY


def fallback_timestamp() -> str:
    """Job-level 'now' in UTC, for documents without extraction metadata."""
    return datetime.now(timezone.utc).isoformat()


def guarded(rows: Column, violations: Column, strict: bool, what: str) -> Column:
    """Generator input that is NULL (no rows) for an invalid document, or
    raises in ``strict`` mode."""
    ok = F.size(violations) == 0
    if not strict:
        return F.when(ok, rows)
    msg = F.concat(F.lit(f"Invalid {what} document: "), F.array_join(violations, ", "))
    return F.when(ok, rows).otherwise(F.raise_error(msg))


def parsed(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Input columns plus ``_v``: the document parsed once (NULL if not JSON).

    The parse sits in a one-element ``explode`` (a Generate node).  Filters
    written or inferred later (``explode(col)`` implies ``size(col) > 0``)
    are pushed down through projections by substituting column definitions;
    a predicate on ``_v`` cannot cross the Generate that produces it, so the
    text is never re-parsed per field.
    """
    one = F.array(F.try_parse_json(F.col(doc_col)))
    return docs.select(*docs.columns, F.explode(one).alias("_v"))


# ---------------------------------------------------------------------------
# Balance documents


def balance_envelope(docs: DataFrame, fallback_ts: str | None = None,
                     doc_col: str = "doc") -> DataFrame:
    """Per document: envelope metadata with defaults, the block list, and the
    reasons the document is invalid (empty when valid).

    A wrapper exists when ``payload`` is an object.  Without it the document
    itself is the payload, slug and name are '' and the geo id is NULL.
    Missing ``included`` means no blocks; present but not a list is invalid.
    """
    ts = fallback_ts or fallback_timestamp()
    d = parsed(docs, doc_col)
    vv = F.col("_v")
    wrapped = is_object(vv, "$.payload")

    def pick(path, default):
        value = json_field_or(vv, path, "string", F.lit(default))
        return F.when(wrapped, value).otherwise(F.lit(default))

    blocks = F.when(wrapped, array_field(vv, "$.payload.included")) \
        .otherwise(array_field(vv, "$.included"))
    # a list is present; the member is only copied where it is none
    inc_present = F.when(blocks.isNotNull(), True).when(wrapped, is_present(vv, "$.payload.included")) \
        .otherwise(is_present(vv, "$.included"))
    e = d.select(
        *docs.columns,
        pick("$.source", BALANCE_SOURCE).alias("source"),
        pick("$.endpoint", BALANCE_ENDPOINT).alias("endpoint"),
        pick("$.region_slug", "").alias("region_slug_doc"),
        pick("$.region_name", "").alias("region_name"),
        F.when(wrapped, json_field(vv, "$.redata_geo_id", "bigint")).alias("redata_geo_id"),
        pick("$.extracted_at", ts).alias("ingestion_timestamp"),
        F.coalesce(json_field(vv, "$.requested_years[0]", "string"),
                   F.substring(json_field(vv, "$.requested_start_date", "string"), 1, 4)).alias("delivery_year"),
        blocks.alias("blocks"),
        is_object(vv).alias("_top_obj"), inc_present.alias("_inc_present"),
    )
    reasons = F.array_compact(F.array(
        F.when(~F.col("_top_obj"), F.lit("top level is not a JSON object")),
        F.when(F.col("_top_obj") & F.col("_inc_present") & F.col("blocks").isNull(),
               F.lit("'included' is not a list"))))
    return e.withColumn("violations", reasons).drop("_top_obj", "_inc_present")


def balance_violations(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Documents the original would refuse, with the reasons."""
    env = balance_envelope(docs, "", doc_col)
    return env.where(F.size("violations") > 0).select(*docs.columns, "violations")


_RECORD_MEASURES, _VALUE_MEASURES = ("total", "total-percentage"), ("value", "percentage")


def _bad(v: Column, prefix: str, names: tuple[str, ...]) -> Column:
    return F.greatest(*[uncastable(v, f"{prefix}['{n}']", "double") for n in names])


def record_reasons(record: Column) -> Column:
    """What is wrong with the measures of a record and of its values (an empty array if nothing is).

    The list of reasons is only made for a record that has some.
    """
    values = F.coalesce(array_field(record, "$.attributes.values"), F.array().cast("array<variant>"))

    def named(v: Column, prefix: str, names: tuple[str, ...], at: Column) -> Column:
        return F.array_compact(F.array(*[
            F.when(uncastable(v, f"{prefix}['{n}']", "double"),
                   F.concat(at, F.lit(f"{n} is not a number: "), json_text(v, f"{prefix}['{n}']"))) for n in names]))

    each = F.flatten(F.transform(values, lambda x, i: named(x, "$", _VALUE_MEASURES, F.concat(
        F.lit("values["), i.cast("string"), F.lit("].")))))
    some = _bad(record, "$.attributes", _RECORD_MEASURES) | F.exists(values, lambda x: _bad(x, "$", _VALUE_MEASURES))
    return F.when(some, F.concat(named(record, "$.attributes", _RECORD_MEASURES, F.lit("")), each)) \
        .otherwise(F.array().cast("array<string>"))


def checked_values(record: Column, strict: bool, what: str = "balance") -> Column:
    """The values of a record, for a generator.  Badly typed measures, which the original's load
    refuses, raise in ``strict`` mode; otherwise the values that hold them are left out, and all values of a record whose
    totals are badly typed."""
    values = array_field(record, "$.attributes.values")
    if strict:
        reasons = record_reasons(record)
        at = F.coalesce(json_field(record, "$.id", "string"), F.lit("null"))
        return F.when(F.size(reasons) == 0, values).otherwise(F.raise_error(F.concat(
            F.lit(f"Invalid {what} record "), at, F.lit(": "), F.array_join(reasons, ", "))))
    return F.when(~_bad(record, "$.attributes", _RECORD_MEASURES),
                  F.filter(values, lambda x: ~_bad(x, "$", _VALUE_MEASURES)))


def measure_violations(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """One row per badly typed measure of valid balance documents: the document's columns, block and record ids, and a
    ``violation`` that names the field and shows its text."""
    env = balance_envelope(docs, "", doc_col)
    b = env.select("*", F.explode(guarded(F.col("blocks"), F.col("violations"), False, "balance")).alias("b"))
    r = b.select("*", F.explode(array_field(F.col("b"), "$.attributes.content")).alias("r"))
    keep = [c for c in docs.columns if c != doc_col]
    return r.select(*keep, json_field(F.col("b"), "$.id", "string").alias("group_id"),
                    json_field(F.col("r"), "$.id", "string").alias("metric_id"),
                    F.explode(record_reasons(F.col("r"))).alias("violation"))


def explode_balance(env: DataFrame, blocks: Column, strict: bool = True) -> DataFrame:
    """Blocks -> content records -> values, to the 22 flat columns.

    A non-object block or record has no ``attributes.content`` /
    ``attributes.values`` array and yields nothing; non-object value items
    are filtered out.  ``strict``: see ``checked_values``.
    """
    b = env.select("*", F.explode(blocks).alias("b"))
    r = b.select("*", F.explode(array_field(F.col("b"), "$.attributes.content")).alias("r"))
    x = r.select("*", F.explode(checked_values(F.col("r"), strict)).alias("x")) \
        .where(is_object(F.col("x")))
    bv, rv, xv = F.col("b"), F.col("r"), F.col("x")
    dt = json_field(xv, "$.datetime", "string")
    out = x.select(
        "source", "endpoint", F.col("region_slug_doc").alias("region_slug"), "region_name",
        "redata_geo_id", "ingestion_timestamp",
        json_field(bv, "$.type", "string").alias("group_type"),
        json_field(bv, "$.id", "string").alias("group_id"),
        json_field(bv, "$.attributes.title", "string").alias("group_title"),
        json_field(rv, "$.type", "string").alias("metric_type"),
        json_field(rv, "$.id", "string").alias("metric_id"),
        json_field(rv, "$.groupId", "string").alias("metric_group_id"),
        json_field(rv, "$.attributes.title", "string").alias("metric_title"),
        json_field(rv, "$.attributes.description", "string").alias("metric_description"),
        json_field(rv, "$.attributes.composite", "boolean").alias("is_composite"),
        json_field(rv, "$.attributes['last-update']", "string").alias("last_update"),
        json_field(rv, "$.attributes.total", "double").alias("total"),
        json_field(rv, "$.attributes['total-percentage']", "double").alias("total_percentage"),
        # month key = first 7 characters of the datetime *text* ('' if absent)
        F.when(is_present(xv, "$.datetime"), F.substring(dt, 1, 7)).otherwise(F.lit(""))
        .alias("year_month"),
        dt.alias("datetime"),
        json_field(xv, "$.value", "double").alias("value"),
        json_field(xv, "$.percentage", "double").alias("percentage"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in BALANCE_FLAT.fields])


def flatten_balance(docs: DataFrame, fallback_ts: str | None = None, strict: bool = True,
                    doc_col: str = "doc") -> DataFrame:
    """Balance documents -> 22-column flat rows.

    ``strict`` raises on documents the original refuses and on badly typed measures; otherwise they are
    dropped (``balance_violations`` and ``measure_violations`` list them).
    """
    env = balance_envelope(docs, fallback_ts, doc_col)
    return explode_balance(env, guarded(F.col("blocks"), F.col("violations"), strict, "balance"), strict)


# ---------------------------------------------------------------------------
# Weather documents

_SERIES_TYPES = {s: ("array<bigint>" if s == "weather_code" else "array<double>")
                 for s in DAILY_SERIES}
_ELEMENT_TYPES = {s: t.removeprefix("array<").removesuffix(">") for s, t in _SERIES_TYPES.items()}
_ENV = [f.name for f in WEATHER_DAILY.fields[:9]]


def weather_arrays(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Per document: envelope columns, ``time`` and the seven series arrays,
    and the reasons the original would raise on the document."""
    d = parsed(docs, doc_col)
    vv = F.col("_v")
    keep = [c for c in docs.columns if c not in set(_ENV)]
    flags = [is_object(vv).alias("_top"),
             is_present(vv, "$.payload").alias("_p"), is_object(vv, "$.payload").alias("_po"),
             is_present(vv, "$.payload.daily").alias("_d"),
             is_object(vv, "$.payload.daily").alias("_do"),
             is_present(vv, "$.payload.daily.time").alias("_t")]
    flags += [is_present(vv, f"$.payload.daily.{s}").alias(f"_s_{s}") for s in DAILY_SERIES]
    env = [json_field(vv, "$.source", "string").alias("source"),
           json_field(vv, "$.extracted_at", "string").alias("ingestion_timestamp"),
           json_field(vv, "$.region_slug", "string").alias("region_slug"),
           json_field(vv, "$.region_name", "string").alias("region_name"),
           json_field(vv, "$.location_name", "string").alias("location_name"),
           json_field(vv, "$.latitude", "double").alias("latitude"),
           json_field(vv, "$.longitude", "double").alias("longitude"),
           json_field(vv, "$.timezone", "string").alias("timezone"),
           json_field(vv, "$.weather_point_type", "string").alias("weather_point_type")]
    arrays = [F.try_variant_get(vv, "$.payload.daily.time", "array<string>").alias("time")]
    arrays += [F.try_variant_get(vv, f"$.payload.daily.{s}", t).alias(s)
               for s, t in _SERIES_TYPES.items()]
    arrays += [array_field(vv, f"$.payload.daily.{s}").alias(f"_raw_{s}") for s in DAILY_SERIES]
    year = F.coalesce(json_field(vv, "$.requested_years[0]", "string"),
                      F.substring(json_field(vv, "$.requested_start_date", "string"), 1, 4))
    e = d.select(*keep, *env, *arrays, *flags, year.alias("delivery_year"))

    n = F.coalesce(F.size("time"), F.lit(0))
    checks = [
        F.when(~F.col("_top"), F.lit("top level is not a JSON object")),
        F.when(F.col("_p") & ~F.col("_po"), F.lit("'payload' is not an object")),
        F.when(F.col("_d") & ~F.col("_do"), F.lit("'payload.daily' is not an object")),
        F.when(F.col("_t") & F.col("time").isNull(), F.lit("'payload.daily.time' is not a list")),
    ]
    for s in DAILY_SERIES:
        present, arr = F.col(f"_s_{s}"), F.col(s)
        # a missing series counts as an empty list; checks run only when
        # there is at least one date (the original loops over dates)
        size = F.when(present, F.size(arr)).otherwise(F.lit(0))
        checks.append(F.when((n > 0) & present & arr.isNull(),
                             F.lit(f"'payload.daily.{s}' is not a list")))
        checks.append(F.when((n > 0) & (~present | arr.isNotNull()) & (size != n),
                             F.concat(F.lit(f"'payload.daily.{s}' has "), size.cast("string"),
                                      F.lit(" values, expected "), n.cast("string"))))
    # elements that are there but no numbers; their list is only made for a series that has some
    bad = [F.when(n > 0, _bad_elements(s, t)) for s, t in _ELEMENT_TYPES.items()]
    return e.select(*keep, *_ENV, "delivery_year", "time", *DAILY_SERIES,
                    F.concat(F.array_compact(F.array(*checks)), *[F.coalesce(b, F.array().cast("array<string>")) for b in bad])
                    .alias("violations"))


def _bad_elements(series: str, type_: str) -> Column:
    """What is wrong with the elements of a series; NULL if nothing is."""
    raw, what = F.col(f"_raw_{series}"), "a whole number" if type_ == "bigint" else "a number"
    named = F.array_compact(F.transform(raw, lambda x, i: F.when(uncastable(x, "$", type_), F.concat(
        F.lit(f"'payload.daily.{series}["), i.cast("string"), F.lit(f"]' is not {what}: "), json_text(x)))))
    return F.when(F.exists(raw, lambda x: uncastable(x, "$", type_)), named)


def weather_violations(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """One row per (document, reason) the original would raise on."""
    w = weather_arrays(docs, doc_col)
    keep = [c for c in docs.columns if c != doc_col and c != "region_slug"]
    return w.select(*keep, "region_slug", F.explode("violations").alias("violation"))


def zip_daily(arrays: DataFrame, strict: bool = True, what: str = "weather") -> DataFrame:
    """``arrays_zip`` + ``inline``: one row per day, 17 columns.  Lengths were
    checked first (``arrays_zip`` would pad short series with NULL)."""
    z = F.arrays_zip(F.col("time").alias("date"), *[F.col(s) for s in DAILY_SERIES])
    out = arrays.select(*_ENV, F.inline(guarded(z, F.col("violations"), strict, what)))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in WEATHER_DAILY.fields])


def flatten_weather(docs: DataFrame, strict: bool = True, doc_col: str = "doc") -> DataFrame:
    """Zip-explode the parallel daily arrays into one row per day; ``strict``
    raises like the original, otherwise bad documents yield no rows."""
    return zip_daily(weather_arrays(docs, doc_col), strict)
