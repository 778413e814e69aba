"""Catalog tables whose data is replaced by a swap of their location.

A table's data lies in a version folder, ``<database folder>/<table>/<version>``.  A rewrite
writes a new version and then points the catalog at it with one ``ALTER TABLE .. SET
LOCATION``: readers see the old data or the new, never a mixture, and a query planned
before the swap finishes on the old files.  Old versions stay until
``drop_old_versions`` removes them.

Partitioned tables list their folders when they are read, instead of keeping them in the
catalog, so that a swap of the location swaps all partitions.

One writer per table: a rewrite that finds the table's version changed since it began to
read raises, as the rows loaded in between would be lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION = "ampora.version"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def quoted(name: str) -> str:
    """``db.table`` with each part quoted."""
    return ".".join(f"`{part}`" for part in name.split("."))


def create_database(spark: SparkSession, database: str, folder: str | None = None) -> None:
    """Create the database if it is absent, in ``folder`` or else in the shared folder."""
    from ampora.session import shared_root
    if not spark.catalog.databaseExists(database):
        folder = folder or f"{shared_root(spark)}/{database}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")


def fresh_location(spark: SparkSession, name: str) -> str:
    """A new version folder of a table."""
    database, table = name.split(".")
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{base}/{table}/{uuid.uuid4().hex[:16]}"


@contextmanager
def _untracked(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_TRACKED)
    spark.conf.set(_TRACKED, "false")
    try:
        yield
    finally:
        spark.conf.set(_TRACKED, before)


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_by: list[str] | None = None, sorted_by: list[str] | None = None) -> None:
    """A parquet table over a version folder.  ``sorted_by`` records the order of rows inside its files."""
    parts = partition_by or []
    fields = [f for f in schema.fields if f.name not in parts] + [schema[p] for p in parts]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    extra = f", 'ampora.sorted_by'='{','.join(sorted_by)}'" if sorted_by else ""
    with _untracked(spark):
        spark.sql(f"CREATE TABLE {quoted(name)} ({columns}) USING parquet{by} LOCATION '{location}' "
                  f"TBLPROPERTIES ('{VERSION}'='0'{extra})")


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


def version(spark: SparkSession, name: str) -> int:
    """Number of loads and rewrites that a table or view has seen."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}
    return int(found.get(VERSION, 0))


def changed(spark: SparkSession, name: str) -> None:
    """Count a load or a rewrite."""
    spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ('{VERSION}'='{version(spark, name) + 1}')")


def swap(spark: SparkSession, name: str, to: str, seen: int) -> None:
    """Point a table at a complete version folder; ``seen``: its version when the rewrite began to read."""
    if version(spark, name) != seen:
        raise RuntimeError(f"{name} was loaded or rewritten while this rewrite ran")
    spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{to}'")
    changed(spark, name)
    spark.catalog.refreshTable(quoted(name))


def add_columns(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Columns of ``df`` that the table lacks become nullable columns of it, in the catalog alone."""
    known = set(spark.table(quoted(name)).columns)
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({columns})")


def drop_old_versions(spark: SparkSession, name: str, older_than_hours: float = 24.0) -> list[str]:
    """Remove version folders that a table no longer points at and that nothing has been written to for so long;
    returns their paths.  Queries planned on them would fail, so leave time for the longest one."""
    now = location(spark, name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(now)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = spark.sparkContext._jvm.System.currentTimeMillis() - int(older_than_hours * 3_600_000)
    gone = []
    for status in fs.listStatus(path.getParent()):
        if status.isDirectory() and status.getPath().getName() != path.getName() and status.getModificationTime() <= limit:
            fs.delete(status.getPath(), True)
            gone.append(status.getPath().toString())
    return gone
