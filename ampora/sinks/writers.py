"""Sinks.  Every write goes to a shared folder (see ``session.shared_root``);
rewrites never overwrite the path they read from."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampora.operators.dedup import dedup_latest
from ampora.sinks import tables


def write_landing(docs: DataFrame, root: str, doc_col: str = "doc") -> None:
    """JSON Lines partitioned by region; a rerun replaces only the regions it
    carries (dynamic partition overwrite).

    The rows are rebalanced by region first: adaptive execution measures each
    region's share of the shuffled bytes, gathers small regions and splits
    large ones over several tasks.  So the number of files is bounded by the
    regions plus the bytes over the advisory partition size, instead of
    input tasks times regions, and a region with a third of all documents is
    still written by many tasks.
    """
    (docs.select("region_slug", F.col(doc_col).alias("value"))
     .hint("rebalance", F.col("region_slug"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("region_slug").text(root))


def write_named_documents(docs: DataFrame, folder: str, pattern: str, doc_col: str = "doc") -> None:
    """One file per region, named by ``pattern`` with the region's slug in place of ``{slug}``; a rerun replaces only
    the files of the regions it carries, each with one move of a complete file.

    Each task writes the documents of its own rows: one document per region is expected, and of several that one
    stays whose task ended last.
    """
    prefix, suffix = pattern.split("{slug}")

    def save(rows: Iterator) -> None:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for r in rows:
            name = f"{prefix}{r['region_slug']}{suffix}"
            draft = f"{root}/_{name}.{uuid.uuid4().hex}"          # names with an underscore aren't read
            with store.open_output_stream(draft) as out:
                out.write(r["doc"].encode())
            store.move(draft, f"{root}/{name}")

    docs.where("region_slug IS NOT NULL").select("region_slug", F.col(doc_col).alias("doc")).foreachPartition(save)


MART_ORDER = ["year_month", "region_name", "metric_type"]


def write_mart(df: DataFrame, path: str) -> None:
    """Full replace of a mart, partitioned by month and sorted by region and
    metric inside each file: a period slice prunes folders, a region or
    metric filter skips row groups by their min/max statistics.

    Range partitioning on (month, region, metric) splits a hot month over
    several tasks (boundaries come from a sample), instead of hashing the
    whole month into one.
    """
    (df.repartitionByRange(*MART_ORDER).sortWithinPartitions(*MART_ORDER)
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("year_month").parquet(path))


def save_mart(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A mart as a catalog table ``db.table``, partitioned by month and sorted by region and metric.

    Each save writes a whole new version and swaps it in, so readers by name see the old mart or
    the new one, and one that began before the swap finishes on the old files.
    """
    tables.create_database(spark, name.split(".")[0])
    known = spark.catalog.tableExists(name)
    seen = tables.version(spark, name) if known else 0
    to = tables.fresh_location(spark, name)
    write_mart(df, to)
    if known:
        tables.add_columns(spark, name, df)
        tables.swap(spark, name, to, seen)
    else:
        tables.create_table(spark, name, df.schema, to, partition_by=["year_month"], sorted_by=MART_ORDER[1:])
    return spark.table(tables.quoted(name)).select(*df.columns)


def write_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full replace of a processed flat table (CSV keeps a header row)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


@dataclass
class Routes:
    """The two tables of a routed write, and their numbers of rows."""

    good: DataFrame
    rejects: DataFrame
    n_good: int
    n_rejects: int


def write_routes(routed: DataFrame, path: str) -> Routes:
    """Write rows with a ``route`` (``good`` or ``rejects``) and a ``reason`` into two tables in one pass.

    One job scans the input once and writes each row to its route's folder; the counts are observed on that write.
    """
    obs = Observation("routes")
    good = F.col("route") == "good"
    (routed.observe(obs, F.count_if(good).alias("good"), F.count_if(~good).alias("rejects"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route").parquet(path))
    back = routed.sparkSession.read.schema(routed.schema).parquet(path)
    return Routes(back.where(F.col("route") == "good").drop("route", "reason"),
                  back.where(F.col("route") == "rejects").drop("route"), int(obs.get["good"]), int(obs.get["rejects"]))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by *name* and type (missing ones as NULL); extra
    input columns are kept at the end (new nullable fields are allowed).
    Empty strings load as NULL, the way blank CSV fields do."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            if isinstance(df.schema[f.name].dataType, T.StringType):
                c = F.nullif(c, F.lit(""))
            cols.append(c.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


def append_load(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Append into a fixed-schema table, creating it when absent.

    Returns the number of rows appended, observed on the write itself (an
    ``Observation`` metric), so no second pass over the data is needed.
    """
    obs = Observation("append_load")
    conform(df, schema).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(obs.get["rows"])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a loaded table by its fixed schema, which may name columns that only some
    loads have: no file's footer is read to find one."""
    return spark.read.schema(schema).parquet(path)


def dedup_rewrite(spark: SparkSession, src: str, dst: str, keys: list[str],
                  schema: T.StructType, order_by: str = "ingestion_timestamp") -> DataFrame:
    """Rewrite a folder keeping the newest row per key into a *new* folder; ``dedup_table`` rewrites
    a catalog table under its name."""
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("dedup_rewrite must write to a new location")
    dedup_latest(read_table(spark, src, schema), keys, order_by).write.mode("overwrite").parquet(dst)
    return read_table(spark, dst, schema)


def append_load_table(spark: SparkSession, df: DataFrame, table: str, schema: T.StructType,
                      database: str = "raw") -> int:
    """Catalog form of ``append_load``: creates the database and table when
    absent, adds new nullable input columns to the table (field addition),
    then appends by column name.  Returns the rows appended.

    The table's schema is the catalog's: it grows there, and no file's footer is read for it.
    """
    tables.create_database(spark, database)
    name = f"{database}.{table}"
    rows = conform(df, schema)
    if not spark.catalog.tableExists(name):
        tables.create_table(spark, name, rows.schema, tables.fresh_location(spark, name))
    tables.add_columns(spark, name, rows)
    current = spark.table(tables.quoted(name))
    aligned = rows.select(*[F.col(c) if c in rows.columns
                            else F.lit(None).cast(current.schema[c].dataType).alias(c)
                            for c in current.columns])
    obs = Observation("append_load_table")
    aligned.observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(tables.quoted(name))
    tables.changed(spark, name)
    return int(obs.get["rows"])


def dedup_table(spark: SparkSession, name: str, keys: list[str], order_by: str = "ingestion_timestamp") -> DataFrame:
    """Rewrite the catalog table ``db.table`` in place, keeping the newest row per key.

    The table's name, columns and properties stay; its data is a new version, swapped in when it is complete.
    Loads that follow append to the deduplicated data, so history is not deduplicated again from all
    deliveries.
    """
    seen = tables.version(spark, name)
    to = tables.fresh_location(spark, name)
    dedup_latest(spark.table(tables.quoted(name)), keys, order_by).write.parquet(to)
    tables.swap(spark, name, to, seen)
    return spark.table(tables.quoted(name))


def create_staging_view(spark: SparkSession, name: str, raw: str, schema: T.StructType, keys: list[str] | None = None,
                        order_by: str = "ingestion_timestamp") -> DataFrame:
    """A staging model as a persistent view over a raw table: typed columns and, with ``keys``, the newest row
    per key in the total order of ``dedup_latest``.  Readers of the view see each later load and rewrite."""
    tables.create_database(spark, name.split(".")[0])
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    source = tables.quoted(raw)
    if keys:
        rest = [f.name for f in schema.fields if f.name not in keys and f.name != order_by]
        order = ", ".join(f"`{c}` DESC NULLS LAST" for c in [order_by, *rest])
        by = ", ".join(f"`{k}`" for k in keys)
        source = (f"(SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS `__ampora_rn` FROM {source}) "
                  "WHERE `__ampora_rn` = 1")
    spark.sql(f"CREATE OR REPLACE VIEW {tables.quoted(name)} AS SELECT {columns} FROM {source}")
    return spark.table(tables.quoted(name))


PART, LOAD = "load_part", "load_version"
MAX_PARTS = 20_000       # partitions of an upserted table; their names are listed in its view


def utc_month(timestamp_col: str) -> Column:
    """Partition of a typed timestamp key: its month in UTC, whatever offset it was delivered in."""
    return F.date_format(timestamp_col, "yyyy-MM")


def _in_force(parts: dict[str, str]) -> Column:
    return F.concat_ws("/", PART, LOAD).isin([f"{p}/{v}" for p, v in sorted(parts.items())])


def touched_rows(spark: SparkSession, name: str, parts: list[str]) -> DataFrame:
    """Rows in force of the named partitions of an upserted table; only their folders are scanned."""
    force = {p: v for p, v in _published(spark, name).items() if p in set(parts)}
    data = spark.table(tables.quoted(f"{name}__data"))
    return data.where(F.col(PART).isin(parts) & _in_force(force)).drop(LOAD)


def _published(spark: SparkSession, name: str) -> dict[str, str]:
    """The version in force of each partition."""
    at = tables.version(spark, name)
    folder = f"{tables.location(spark, f'{name}__data')}__published/{at}"
    return {r[PART]: r[LOAD] for r in spark.read.schema(f"{PART} string, {LOAD} string").parquet(folder).collect()}


def upsert_latest(spark: SparkSession, batch: DataFrame, name: str, keys: list[str],
                  part: Column, order_by: str = "ingestion_timestamp") -> DataFrame:
    """Load into the catalog table ``db.table`` and keep the newest row per key,
    rewriting only the partitions the load touches.

    ``part`` is the partition of a row, a function of the typed key, so equal
    keys always land in the same partition and a dedup inside the touched
    partitions equals a dedup of the whole table; NULL is a partition of its
    own.  At most ``MAX_PARTS`` partitions, as their names pass through the driver.

    The rows lie in ``db.table__data``, in a folder per partition and version; the name is a view that lists the
    version in force of each partition.  A load scans the touched partitions in force (partition
    filters on literals), merges them with the batch, writes them once as new versions, and replaces the view
    with one statement: readers see all of a load or nothing, and other partitions are neither
    read nor written.  A load that fails leaves versions that no view lists.
    """
    tables.create_database(spark, name.split(".")[0])
    new = batch.withColumn(PART, F.coalesce(part.cast("string"), F.lit("none")))
    parts = [r[PART] for r in new.select(PART).distinct().limit(MAX_PARTS + 1).collect()]
    data = f"{name}__data"
    if not spark.catalog.tableExists(data):
        stored = new.withColumn(LOAD, F.lit(""))
        tables.create_table(spark, data, stored.schema, tables.fresh_location(spark, data), partition_by=[PART, LOAD])
    if not spark.catalog.tableExists(name):
        _publish(spark, name, 0, {})
    at = tables.version(spark, name) + 1
    load = f"{at}-{uuid.uuid4().hex[:8]}"          # a load that failed may have left its own
    force = _published(spark, name) | dict.fromkeys(parts, load)
    if len(force) > MAX_PARTS:
        raise ValueError(f"more than {MAX_PARTS} partitions")
    tables.add_columns(spark, data, new)
    both = touched_rows(spark, name, parts).unionByName(new, allowMissingColumns=True)
    # the window shuffles by key, at most one row per key and map task; rebalancing then gathers a
    # partition's rows in few files and splits a hot one by its measured size
    (dedup_latest(both, [PART, *keys], order_by).withColumn(LOAD, F.lit(load))
     .hint("rebalance", F.col(PART)).write.mode("append").partitionBy(PART, LOAD).parquet(tables.location(spark, data)))
    spark.catalog.refreshTable(tables.quoted(data))
    _publish(spark, name, at, force)
    return spark.table(tables.quoted(name))


def _publish(spark: SparkSession, name: str, at: int, force: dict[str, str]) -> None:
    """Replace the view; the list of versions is written before, under the view's new version number."""
    data = spark.table(tables.quoted(f"{name}__data"))
    listed = json.dumps([{PART: p, LOAD: v} for p, v in sorted(force.items())])
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(listed), f"array<struct<{PART}:string,{LOAD}:string>>")))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{tables.location(spark, f'{name}__data')}__published/{at}")
    columns = ", ".join(f"`{c}`" for c in data.columns if c not in (PART, LOAD))
    listed = ", ".join("'" + f"{p}/{v}".replace("\\", "\\\\").replace("'", "\\'") + "'" for p, v in sorted(force.items()))
    spark.sql(f"CREATE OR REPLACE VIEW {tables.quoted(name)} TBLPROPERTIES ('{tables.VERSION}'='{at}') AS "
              f"SELECT {columns} FROM {tables.quoted(f'{name}__data')} "
              f"WHERE {f'concat_ws(chr(47), {PART}, {LOAD}) IN ({listed})' if force else 'false'}")
