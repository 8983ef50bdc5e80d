"""Stored tables and live reports by name, in the catalog that all sessions share.

A stored table is a partitioned catalog table over its published folders, one partition for each, and a view
of its name with its columns alone. Publishing adds, drops or redirects the partitions a load has changed, so every
session reads the new state with its next query, and Spark lists only the folders it needs. Reports are
views over these names: plans without a job, run when they are read. With a persistent metastore the names
outlast the application; without one ``TableStore(spark, root, database).register()`` brings them back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

SLICE = "slice"
_BATCH = 500  # partitions of one statement


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Catalog:
    def __init__(self, spark: SparkSession, root: str, database: str):
        self.spark, self.root, self.database = spark, root, database
        if not spark.catalog.databaseExists(database):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_quoted(f'{root}/names')}")

    def _name(self, table: str) -> str:
        return f"{self.database}.`{table}`"

    def has(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def publish(
        self, table: str, schema: StructType, folders: Mapping[str, str], moved: Iterable[str] | None = None
    ) -> None:
        """Let the name ``table`` read these folders, by slice.

        ``moved`` names the slices whose folder may be another than before; without it they all may.
        """
        files, home = self._name(f"{table}_files"), f"{self.root}/names/{table}"
        known = self._known(f"{table}_files", schema, home)
        if known is None:
            self.spark.sql(f"DROP TABLE IF EXISTS {files}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {files} ({columns}, {SLICE} STRING) USING parquet"
                f" PARTITIONED BY ({SLICE}) LOCATION {_quoted(home)} TBLPROPERTIES ('home' = {_quoted(home)})"
            )
            known = set()
            self.view(table, f"SELECT {', '.join(f'`{c}`' for c in schema.names)} FROM {files}")
        for part in sorted(known & folders.keys() & (known if moved is None else set(moved))):
            place = _quoted(folders[part])
            self.spark.sql(f"ALTER TABLE {files} PARTITION ({SLICE} = {_quoted(part)}) SET LOCATION {place}")
        for some in _some(folders.keys() - known):
            parts = [f"PARTITION ({SLICE} = {_quoted(s)}) LOCATION {_quoted(folders[s])}" for s in some]
            self.spark.sql(f"ALTER TABLE {files} ADD IF NOT EXISTS {' '.join(parts)}")
        for some in _some(known - folders.keys()):
            parts = [f"PARTITION ({SLICE} = {_quoted(s)})" for s in some]
            self.spark.sql(f"ALTER TABLE {files} DROP IF EXISTS {', '.join(parts)}")

    def _known(self, files: str, schema: StructType, home: str) -> set[str] | None:
        """The slices of a table of these columns in this folder, None if there is no such table."""
        if not self.has(files):
            return None
        name = self._name(files)
        made_in = self.spark.sql(f"SHOW TBLPROPERTIES {name} ('home')").first()["value"]
        columns = [(f.name, f.dataType) for f in self.spark.table(name).schema.fields[:-1]]
        if made_in != home or columns != [(f.name, f.dataType) for f in schema.fields]:
            return None
        return {unquote(r[0].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}

    def view(self, name: str, sql: str) -> None:
        """A stored view, run when it is read. A temporary view of the name would hide it."""
        self.spark.catalog.dropTempView(name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(name)} AS {sql}")


def _some(parts: set[str]) -> Iterator[list[str]]:
    ordered = sorted(parts)
    return (ordered[at : at + _BATCH] for at in range(0, len(ordered), _BATCH))
