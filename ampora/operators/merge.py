"""Merge yearly deliveries of one region into one series.

Balance: blocks matched by ``id``, records by ``id`` inside a block; values
are concatenated; descriptive attributes come from the first year a block or
record is seen; ``total`` / ``total-percentage`` become NULL for a record
that two or more payloads hold.  Weather: every daily array is appended and
the envelope of the first year is kept.

Documents are parsed once, into a narrow table under the shared folder (balance: a row per region,
block, record and payload with its values as one typed array; weather: a row per document with its
arrays).  Facts per key come from one grouped aggregate over a few columns of that table, joined back
to it; values are exploded last, so no grouping carries value rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampora.constants import DAILY_SERIES
from ampora.functions.columns import array_field, is_object, is_present, json_field
from ampora.operators.flatten import (balance_envelope, checked_values, guarded, weather_arrays,
                                      zip_daily)
from ampora.schemas import BALANCE_FLAT, WEATHER_ENVELOPE
from ampora.session import scratch_path


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL matches NULL (a missing id is a key
    of its own, as in the original's dict lookups)."""
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_k_{k}"]) for k in keys]
    return left.join(r, cond).drop(*[f"_k_{k}" for k in keys])


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table under the shared folder, read back by its schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _year(docs: DataFrame) -> Column:
    """Year of a delivery: a column of that name, else what the document says was requested; without either it is the last."""
    known = [F.col("year").cast("string")] if "year" in docs.columns else []
    return F.coalesce(*known, F.col("delivery_year"), F.lit("9999"))


def balance_records(docs: DataFrame, doc_col: str = "doc", fallback_ts: str | None = None,
                    strict: bool = True) -> DataFrame:
    """A row per region, payload, block and record of yearly balance documents.

    The region is the landing folder's ``region_slug`` where the input has that column, else the envelope's.
    A payload whose ``included`` is not a list is an error in ``strict`` mode, as in the original, and so is a badly typed
    measure.  Every block also yields one marker row (``is_block``, no record), so a
    block is "seen" in a year even when its content holds no valid record.
    """
    env = balance_envelope(docs, fallback_ts, doc_col)
    slug = F.col("region_slug_doc")
    region = slug
    if "region_slug" in docs.columns:
        region, slug = F.col("region_slug"), F.when((slug == "") & F.col("region_slug").isNotNull(), F.col("region_slug")).otherwise(slug)
    head = F.struct("source", "endpoint", slug.alias("region_slug"), "region_name", "redata_geo_id", "ingestion_timestamp")
    b = env.select(region.alias("region"), _year(docs).alias("year"), head.alias("envelope"), F.explode(
        guarded(F.col("blocks"), F.col("violations"), strict, "balance payload")).alias("b"))
    bv, rv = F.col("b"), F.col("r")
    # a non-object block has no content array; non-object records are dropped
    marker = F.lit(None).cast("variant")
    content = array_field(F.col("b"), "$.attributes.content")
    items = F.concat(F.array(marker), F.coalesce(content, F.array(marker)))
    # a block's own members are read once, and the block isn't copied to each of its records
    r = b.select("region", "year", "envelope", json_field(bv, "$.id", "string").alias("group_id"),
                 F.struct(json_field(bv, "$.type", "string").alias("group_type"),
                          json_field(bv, "$.attributes.title", "string").alias("group_title")).alias("block_attrs"),
                 F.posexplode(items).alias("_pos", "r")).where((F.col("_pos") == 0) | is_object(F.col("r")))
    # all members of a value at once; one that is no object has no struct
    objects = F.filter(F.transform(checked_values(rv, strict, "balance payload"), lambda x: json_field(
        x, "$", "struct<datetime:variant,value:double,percentage:double>")), lambda x: x.isNotNull())
    values = F.transform(objects, lambda x: F.struct(
        json_field(x["datetime"], "$", "string").alias("datetime"), x["datetime"].isNotNull().alias("dated"),
        x["value"].alias("value"), x["percentage"].alias("percentage")))
    return r.select(
        "region", "year", "envelope", (F.col("_pos") == 0).alias("is_block"), "group_id", "block_attrs",
        json_field(rv, "$.id", "string").alias("metric_id"),
        F.struct(json_field(rv, "$.type", "string").alias("metric_type"),
                 json_field(rv, "$.groupId", "string").alias("metric_group_id"),
                 json_field(rv, "$.attributes.title", "string").alias("metric_title"),
                 json_field(rv, "$.attributes.description", "string").alias("metric_description"),
                 json_field(rv, "$.attributes.composite", "boolean").alias("is_composite"),
                 json_field(rv, "$.attributes['last-update']", "string").alias("last_update"))
        .alias("record_attrs"),
        json_field(rv, "$.attributes.total", "double").alias("total"),
        json_field(rv, "$.attributes['total-percentage']", "double").alias("total_percentage"),
        values.alias("values"))


def merge_balance_years(docs: DataFrame, doc_col: str = "doc", fallback_ts: str | None = None,
                        strict: bool = True) -> DataFrame:
    """The 22 flat columns of the merged balance payload of every region, and ``n_payloads``.

    The envelope is that of a region's first year, as in ``merge_weather_years``.
    """
    rec = _written(balance_records(docs, doc_col, fallback_ts, strict), "merge-balance")
    # Per-key facts come from ONE grouped aggregate (combined map-side: one
    # row per block key and per record key), joined back onto the record
    # rows, so value rows are never shuffled by key.  Block attributes reach their records by a window over
    # the *aggregated* key rows (one row per key: its size is the number of
    # metrics of a block, not data volume).  The key table is small: AQE
    # broadcasts it from its measured size, and if it is not small the
    # sort-merge join's skew handling splits a hot region.  A window over the
    # record rows themselves would put a hot region in one task.
    # min over (year, attributes): the first year wins and equal years are
    # resolved by a total order, so a retried task picks the same row
    keys = rec.groupBy("region", "group_id", "is_block", "metric_id").agg(
        F.min(F.struct("year", "block_attrs"))["block_attrs"].alias("_battrs"),
        F.min(F.struct("year", "record_attrs"))["record_attrs"].alias("_rattrs"),
        F.min(F.struct("year", "envelope")).alias("_first"),
        # payloads, not years: a year delivered again has its values twice, and no total
        F.count(F.when(~F.col("is_block"), 1)).alias("n_payloads"))
    per_block = Window.partitionBy("region", "group_id")
    per_region = Window.partitionBy("region")
    keyed = (keys.withColumn("_battrs", F.first(F.when(F.col("is_block"), F.col("_battrs")),
                                                ignorenulls=True).over(per_block))
             .withColumn("_env", F.min("_first").over(per_region)["envelope"])
             .where(~F.col("is_block")).drop("is_block", "_first"))
    rec = _join_null_safe(rec.where(~F.col("is_block")).drop("is_block", "envelope"), keyed,
                          ["region", "group_id", "metric_id"])
    x = rec.select("*", F.explode("values").alias("x"))
    once = F.col("n_payloads") == 1
    out = x.select(
        F.col("_env.*"),
        F.col("_battrs.group_type").alias("group_type"), "group_id",
        F.col("_battrs.group_title").alias("group_title"),
        "_rattrs.metric_type", "metric_id", "_rattrs.metric_group_id", "_rattrs.metric_title",
        "_rattrs.metric_description", "_rattrs.is_composite", "_rattrs.last_update",
        F.when(once, F.col("total")).alias("total"),
        F.when(once, F.col("total_percentage")).alias("total_percentage"),
        F.when(F.col("x.dated"), F.substring("x.datetime", 1, 7)).otherwise(F.lit("")).alias("year_month"),
        "x.datetime", "x.value", "x.percentage",
        F.col("n_payloads").cast("long").alias("n_payloads"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in BALANCE_FLAT.fields], "n_payloads")


def merge_weather_years(docs: DataFrame, doc_col: str = "doc", strict: bool = True) -> DataFrame:
    """Daily rows of the merged weather payload of every region.

    Each yearly document is checked on its own (a non-list or short series
    is an error -- stricter than the original, which checks after merging).
    The envelope of a region's first year is kept: it comes from a grouped
    ``min`` over (year, envelope) -- one row per region, combined map-side over the envelope columns of the written
    table, so a region with a third of all documents is still cheap -- joined back
    on the region by its measured size.
    """
    a = _written(weather_arrays(docs, doc_col).select(*WEATHER_ENVELOPE, "time", *DAILY_SERIES, "violations", _year(docs).alias("year")),
                 "merge-weather")
    env_cols = [c for c in WEATHER_ENVELOPE if c != "region_slug"]
    first = a.groupBy("region_slug").agg(
        F.min(F.struct("year", F.struct(*env_cols).alias("e")))["e"].alias("_env"))
    # a document without a region is a region of its own
    merged = _join_null_safe(a.drop(*env_cols), first, ["region_slug"]).select(
        "*", *[F.col(f"_env.{c}").alias(c) for c in env_cols]).drop("_env")
    return zip_daily(merged, strict=strict, what="weather payload")
