"""Produced databases as a source (A3): what a catalog lists, and reads that may fail.

"Could not be opened" and "holds nothing" are opposite facts.  A database that
the catalog cannot list is a row with an ``error``; a table that cannot be read is
an error beside the other tables, not an exception that ends them all.  Listings
are metadata, one call per named database.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

LISTING = "database string, name string, error string"


def _cause(e: Exception) -> str:
    """The error class alone: messages name paths and change between versions."""
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    return condition or type(e).__name__


def list_tables(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """(database, name, error): one row per table of each named database; one with
    ``error`` and no name for a database that cannot be listed.  An empty database
    that can be opened gives no row."""
    rows = []
    for db in databases:
        try:
            if not spark.catalog.databaseExists(db):
                raise LookupError(db)
            rows += [(db, t.name, None) for t in spark.catalog.listTables(db) if not t.isTemporary]
        except Exception as e:  # noqa: BLE001 -- any failure is this database's error row
            cause = "not found" if isinstance(e, LookupError) else _cause(e)
            rows.append((db, None, f"could not open {db}: {cause}"))
    return spark.createDataFrame(rows, LISTING)


def read_table(spark: SparkSession, database: str, table: str) -> tuple[DataFrame | None, str | None]:
    """(table, None), or (None, cause) if it is not there, cannot be analysed, or its
    first row cannot be read.  A file that breaks further on still fails its job."""
    try:
        df = spark.table(f"`{database}`.`{table}`")
        df.limit(1).collect()
        return df, None
    except Exception as e:  # noqa: BLE001 -- the cause is the result
        return None, _cause(e)


def create_database(spark: SparkSession, name: str, location: str, tables: Mapping[str, str] = {},
                    views: Mapping[str, str] = {}) -> None:
    """A database with ``tables`` (name -> "schema USING format LOCATION path" text) and
    ``views`` (name -> query text)."""
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{location}'")
    for table, text in tables.items():
        spark.sql(f"CREATE TABLE `{name}`.`{table}` {text}")
    for view, text in views.items():
        spark.sql(f"CREATE VIEW `{name}`.`{view}` AS {text}")


def drop_databases(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
