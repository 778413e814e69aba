"""Landed-document scans and top-level JSON checks.

Landing layout: JSON Lines, one document per line, partitioned by
``region_slug`` (``<root>/region_slug=<slug>/part-*.txt``).  Selecting
regions is then partition pruning, and every document stays one row.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampora.functions.columns import is_object, is_present


# the folder's slug stays text: inferred, "01" would be the number 1
LANDING = "value string, region_slug string"


def scan_documents(spark: SparkSession, root: str, region_slugs: list[str] | None = None,
                   one_per_file: bool = False, newest_first: bool = False) -> DataFrame:
    """Documents with their file name and modification time.

    ``region_slugs`` reads only those partition folders; a requested region
    without a folder is an error, found from the folder listing alone (no
    data is read to check it).  ``one_per_file`` reads every file whole
    (``wholetext``), for landings that hold one pretty-printed document per
    file.  Row order carries no meaning downstream, so the original's
    newest-first file order is opt-in (``newest_first``): it is a global sort.
    """
    base = root.rstrip("/")
    if region_slugs:
        paths = [f"{base}/region_slug={s}" for s in dict.fromkeys(region_slugs)]
        try:
            raw = spark.read.schema(LANDING).option("basePath", base).text(paths, wholetext=one_per_file)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            missing = [p.rsplit("=", 1)[1] for p in paths if p in str(e)]
            raise FileNotFoundError(f"No documents for regions: {missing or region_slugs}") from e
    else:
        raw = spark.read.schema(LANDING).text(base, wholetext=one_per_file)
    docs = raw.select(
        "region_slug", F.col("value").alias("doc"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_mtime"))
    if newest_first:
        docs = docs.orderBy(F.col("file_mtime").desc(), F.col("file_name"))
    return docs


def latest_document(docs: DataFrame, order_col: str, tie_col: str) -> DataFrame:
    """Top-1 by ``order_col`` (newest), ties broken by ``tie_col`` descending.

    Planned as a distributed top-k (TakeOrderedAndProject): each task keeps
    one candidate, the driver merges one row per task.
    """
    return docs.orderBy(F.col(order_col).desc_nulls_last(), F.col(tie_col).desc()).limit(1)


def parse_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Adds ``v`` (VARIANT, NULL when the text is not JSON), ``parse_ok`` and
    ``is_object`` (top level must be an object)."""
    v = F.try_parse_json(F.col(doc_col))
    return (docs.withColumn("v", v)
            .withColumn("parse_ok", F.col("v").isNotNull())
            .withColumn("is_object", is_object(F.col("v"))))


def split_documents(docs: DataFrame, doc_col: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(objects, rejects): rejects carry a ``reason``; nothing is collected.  Each output scans and parses by itself;
    ``routed_documents`` fills both from one pass."""
    p = parse_documents(docs, doc_col)
    good = p.where(F.col("is_object")).drop("parse_ok", "is_object")
    bad = p.where(~F.col("is_object")).select(
        *[c for c in docs.columns],
        F.when(~F.col("parse_ok"), F.lit("invalid_json"))
        .otherwise(F.lit("not_an_object")).alias("reason"))
    return good, bad


def payload_errors(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Flags documents carrying a top-level ``errors`` member (even ``null``).

    A key-presence test, not a path lookup: ``{"errors": null}`` counts.
    Arrays and broken text are not objects and count as False.
    """
    has = F.coalesce(F.array_contains(F.json_object_keys(F.col(doc_col)), "errors"), F.lit(False))
    return docs.withColumn("has_errors", has)


def split_error_payloads(docs: DataFrame, doc_col: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(good, rejects) by the top-level ``errors`` member; nothing collected."""
    flagged = payload_errors(docs, doc_col)
    return (flagged.where(~F.col("has_errors")).drop("has_errors"),
            flagged.where(F.col("has_errors")).drop("has_errors"))


def routed_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Input columns, ``reason`` (NULL for a good document) and ``route`` (``good`` or ``rejects``), from one parse.

    A document is rejected that is no JSON, whose top level is no object, or that carries an
    ``errors`` member.  Write it with ``sinks.writers.write_routes``: one scan fills both tables.
    """
    from ampora.operators.flatten import parsed
    v = F.col("_v")
    reason = (F.when(v.isNull(), F.lit("invalid_json")).when(~is_object(v), F.lit("not_an_object"))
              .when(is_present(v, "$.errors"), F.lit("errors_member")))
    p = parsed(docs, doc_col).select(*docs.columns, reason.alias("reason"))
    return p.withColumn("route", F.when(F.col("reason").isNull(), F.lit("good")).otherwise(F.lit("rejects")))


def read_daily_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flattened daily weather written as CSV (header row), with the fixed
    17-column schema instead of inference."""
    from ampora.schemas import WEATHER_DAILY
    return spark.read.schema(WEATHER_DAILY).option("header", True).csv(path)


# --- fixed values: per-region file names of a one-document-per-file landing --
BALANCE_FILE_PATTERN = "redata_{slug}_monthly_sample.json"
WEATHER_FILE_PATTERN = "openmeteo_{slug}_daily_sample.json"


def scan_named_documents(spark: SparkSession, folder: str, pattern: str,
                         region_slugs: list[str] | None = None,
                         file_name: str | None = None) -> DataFrame:
    """One-document-per-file landing (pretty-printed JSON, any size per file).

    Resolution as in the original: an explicit ``file_name``, else one file
    per requested region (``pattern`` with ``{slug}``), else every ``*.json``
    in the folder.  A named or requested file that does not exist is an
    error, raised from the file listing alone.  ``region_slug`` is taken from
    the file name when it matches ``pattern``.
    """
    base = folder.rstrip("/")
    if file_name:
        paths = [f"{base}/{file_name}"]
    elif region_slugs:
        paths = [f"{base}/{pattern.format(slug=s)}" for s in dict.fromkeys(region_slugs)]
    else:
        paths = [f"{base}/*.json"]
    try:
        raw = spark.read.text(paths, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise FileNotFoundError(f"no such document file: {[p for p in paths if p in str(e)] or paths}") from e
    prefix, suffix = pattern.split("{slug}")
    name = F.col("_metadata.file_name")
    slug = F.regexp_extract(name, "^" + _re_escape(prefix) + "(.*)" + _re_escape(suffix) + "$", 1)
    return raw.select(F.nullif(slug, F.lit("")).alias("region_slug"), F.col("value").alias("doc"),
                      name.alias("file_name"),
                      F.col("_metadata.file_modification_time").alias("file_mtime"))


def _re_escape(text: str) -> str:
    import re
    return re.escape(text)
