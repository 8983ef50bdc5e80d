"""Stored tables: Parquet folders, and a short list of those that are current.

A load writes new folders only, then publishes all its tables at once by the list of the next version. Until
then readers see the tables as before; a load that fails leaves them untouched. A table with a
slice date keeps one folder per month, and a load replaces the months it touches. It finds those by an index
of its keys and their months, not in the table. Folders no longer listed may be deleted once no reader needs
them. One job at a time may publish: of two the second fails, as its version is there already.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.calendar import month_label
from tallyloom.operators.integrity import constraint_violations, require
from tallyloom.operators.merge import require_new_keys, survivors, untouched, with_defaults
from tallyloom.operators.star import DIGEST, row_digest
from tallyloom.plans.catalog import Catalog
from tallyloom.schemas import DATA_QUALITY_LOGS, PIPELINE_RUNS, STG_SALES, TABLES, TableSpec
from tallyloom.sources.folders import exists, names

WHOLE = "all"
_SLICE = "month_slice"
_NO_MONTH = "none"
_BATCH = "+"  # between the month and the id of an appended batch
_CURRENT = "table_name string, slice string, path string, published_at timestamp"
_INDEX = "months_of_"
#: Tables that others write and name; here they are only made, empty, where they are missing.
UNSTORED = (STG_SALES.name, PIPELINE_RUNS.name, DATA_QUALITY_LOGS.name)
#: Batches of an index that are joined into one.
INDEX_BATCHES = 16

Slices = dict[str, str | None]


def _month_of(part: str) -> str:
    return part.partition(_BATCH)[0]


class TableStore:
    """The tables under one folder. With a ``database`` every published state is readable there by name."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root
        self.catalog = Catalog(spark, root, database) if database else None
        self._pending: dict[str, Slices] = {}
        self._listed: dict[tuple, DataFrame] = {}
        self.version, self._slices = self._current()

    def _list(self, version: int) -> str:
        return f"{self.root}/current/version={version}"

    def _current(self) -> tuple[int, dict[str, dict[str, str]]]:
        """The folder of every slice as of the last version: one short row for each."""
        versions = [int(name.partition("=")[2]) for name in names(self.spark, f"{self.root}/current")]
        version = max((v for v in versions if exists(self.spark, f"{self._list(v)}/_SUCCESS")), default=0)
        slices: dict[str, dict[str, str]] = {}
        if version:
            for row in self.spark.read.schema(_CURRENT).parquet(self._list(version)).collect():
                slices.setdefault(row["table_name"], {})[row["slice"]] = row["path"]
        return version, slices

    def read(self, spec: TableSpec, months: set[str] | None = None, digest: bool = False) -> DataFrame:
        """The current table, or only some of its months; empty if nothing is stored. ``digest`` adds ``DIGEST``."""
        schema = T.StructType([*spec.schema.fields, T.StructField(DIGEST, T.StringType())]) if digest else spec.schema
        current = self._slices.get(spec.name, {})
        paths = [p for s, p in sorted(current.items()) if months is None or _month_of(s) in months]
        # Folders never change once written: one listing of them serves every reader.
        known = (spec.name, digest, *paths)
        if known not in self._listed:
            self._listed[known] = (
                self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
            )
        return self._listed[known]

    def open_spec(self, name: str, batch: DataFrame | None = None, key: str | None = None) -> TableSpec:
        """The definition of a table outside ``TABLES``: its stored columns, or those of its first batch.

        A later batch must bring the same columns, in any order.
        """
        paths = sorted(self._slices.get(name, {}).values())
        schema = self.spark.read.parquet(paths[0]).schema if paths else batch.schema
        if batch is not None and set(batch.columns) != set(schema.names):
            raise ValueError(f"{name} has the columns {schema.names}, the batch {batch.columns}")
        return TableSpec(name, schema, key)

    def register(self, changes: dict[str, Slices] | None = None) -> None:
        """Make every table, or those changed, readable by name in any session of the catalog."""
        if self.catalog is None:
            self.catalog = Catalog(self.spark, self.root, "default")
        told = [*TABLES, *(name for name in self._slices if name not in TABLES and not name.startswith(_INDEX))]
        for name in told:
            slices = self._slices.get(name, {})
            elsewhere = name in UNSTORED and self.catalog.has(name)
            if (changes is None or name in changes) and (name in TABLES or slices) and not elsewhere:
                schema = (TABLES.get(name) or self.open_spec(name)).schema
                self.catalog.publish(name, schema, slices, None if changes is None else changes[name])

    def _new_folder(self, name: str) -> str:
        return f"{self.root}/tables/{name}/{uuid.uuid4().hex}"

    def write_whole(self, spec: TableSpec, rows: DataFrame) -> Slices:
        """Write a table anew; returns the entries to stage."""
        path = self._new_folder(spec.name)
        kept = [row_digest(rows, rows, spec.digest_of).alias(DIGEST)] if spec.digest_of else []
        rows.select(*spec.columns, *kept).write.parquet(path)
        return {**{s: None for s in self._slices.get(spec.name, {})}, WHOLE: path}

    def _month(self, spec: TableSpec) -> Column:
        date = F.col(spec.slice_date)
        if isinstance(spec.schema[spec.slice_date].dataType, T.IntegerType):
            date = F.to_date(date.cast("string"), "yyyyMMdd")
        return F.coalesce(month_label(date), F.lit(_NO_MONTH))

    def _write_months(self, spec: TableSpec, rows: DataFrame) -> dict[str, str]:
        """One folder per month. Rebalancing joins small pieces and splits a month that holds much."""
        path = self._new_folder(spec.name)
        sliced = rows.select(*spec.columns, self._month(spec).alias(_SLICE)).hint("rebalance", _SLICE)
        sliced.write.partitionBy(_SLICE).parquet(path)
        return {name.partition("=")[2]: f"{path}/{name}" for name in names(self.spark, path)}

    def upsert(self, spec: TableSpec, staged: DataFrame, seq: str, now: dt.datetime) -> Slices:
        """Merge a staged batch; returns the entries to stage. Those of its index are staged already.

        ``staged`` should be a stored table: the checks and the merge read it in turn. Of a table
        kept by month, only the months of staged rows and of the rows they replace are read and rewritten.
        """
        require(constraint_violations(staged, spec, with_keys=False))
        arrived = with_defaults(survivors(staged, spec.primary_key, spec.unique, seq), spec, now)
        if spec.slice_date is None:
            kept = untouched(self.read(spec), staged, spec.primary_key, spec.unique)
            return self.write_whole(spec, kept.unionByName(arrived))
        months = self._touched_months(spec, staged)
        kept = untouched(self.read(spec, months), staged, spec.primary_key, spec.unique)
        changed = self.replace_months(spec, kept.unionByName(arrived), months)
        self._add_to_index(spec, staged)
        return changed

    def _index_spec(self, spec: TableSpec, column: str) -> TableSpec:
        schema = T.StructType([T.StructField(column, spec.schema[column].dataType), T.StructField("month", T.StringType())])
        return TableSpec(f"{_INDEX}{spec.name}_{column}", schema, None)

    def _touched_months(self, spec: TableSpec, staged: DataFrame) -> set[str]:
        """The months of staged rows, and those in which the index has seen one of their keys.

        An entry may be older than the row's last move, which costs rewriting a month in vain. Of the index only
        what lies between the batch's least and greatest key is read: entries are sorted by key.
        """
        kinds = {c: spec.schema[c].dataType for c in spec.keys}
        edges = staged.agg(
            F.collect_set(self._month(spec)).alias("months"),
            *[f(F.col(c).cast(k)).alias(f"{e}_{c}") for c, k in kinds.items() for e, f in (("low", F.min), ("high", F.max))],
        ).first()
        months = set(edges["months"])
        hits = []
        for column, kind in kinds.items():
            if edges[f"low_{column}"] is not None:
                seen = self.read(self._index(spec, column)).filter(
                    F.col(column).between(F.lit(edges[f"low_{column}"]), F.lit(edges[f"high_{column}"]))
                )
                keys = staged.select(F.col(column).cast(kind).alias(column))
                hits.append(seen.join(keys, column, "left_semi").select("month"))
        if hits:
            months |= {r[0] for r in reduce(DataFrame.union, hits).distinct().collect()}
        return months

    def _index(self, spec: TableSpec, column: str) -> TableSpec:
        """The index of a key column; one that is missing is made from the table, once."""
        index = self._index_spec(spec, column)
        if index.name not in self._slices and self._slices.get(spec.name):
            rows = self.read(spec).select(column, self._month(spec).alias("month"))
            self.stage({index.name: self.write_whole(index, rows.repartitionByRange(column).sortWithinPartitions(column))})
        return index

    def _add_to_index(self, spec: TableSpec, staged: DataFrame) -> None:
        """Stage the keys of a batch with their months: one more folder, or all folders as one."""
        for column in spec.keys:
            index = self._index(spec, column)
            kind = spec.schema[column].dataType
            rows = staged.select(F.col(column).cast(kind).alias(column), self._month(spec).alias("month"))
            rows = rows.filter(F.col(column).isNotNull())
            held = self._slices.get(index.name, {})
            full = len(held) >= INDEX_BATCHES
            if full:
                rows = rows.union(self.read(index))
            path = self._new_folder(index.name)
            # Dealt by the key first: alike rows lie together then, and need no shuffle of their own.
            rows.repartitionByRange(column).distinct().sortWithinPartitions(column).write.parquet(path)
            gone = {s: None for s in held} if full else {}
            self.stage({index.name: {**gone, f"{WHOLE}{_BATCH}{uuid.uuid4().hex}": path}})

    def replace_months(self, spec: TableSpec, rows: DataFrame, months: set[str]) -> Slices:
        """``rows`` become all that the table holds of ``months``; returns the entries to stage."""
        gone = {s: None for s in self._slices.get(spec.name, {}) if _month_of(s) in months}
        return {**gone, **self._write_months(spec, rows)}

    def staged_months(self, spec: TableSpec) -> set[str]:
        """The months whose content is staged but not yet published."""
        return {_month_of(part) for part in self._pending.get(spec.name, {})}

    def append(self, spec: TableSpec, staged: DataFrame, now: dt.datetime) -> Slices:
        """Add a batch whose keys are all new; no stored row is rewritten."""
        require(constraint_violations(staged, spec, with_keys=False))
        require_new_keys(self.read(spec), staged, spec)
        rows, batch = with_defaults(staged, spec, now), uuid.uuid4().hex
        if spec.slice_date is not None:
            written = self._write_months(spec, rows)
            self._add_to_index(spec, staged)
        else:
            written = {WHOLE: self._new_folder(spec.name)}
            rows.write.parquet(written[WHOLE])
        return {f"{month}{_BATCH}{batch}": path for month, path in written.items()}

    def stage(self, changes: dict[str, Slices]) -> None:
        """Let this store read the changed tables; others see them after ``publish``."""
        for table, slices in changes.items():
            self._pending.setdefault(table, {}).update(slices)
            current = self._slices.setdefault(table, {})
            for part, path in slices.items():
                if path is None:
                    current.pop(part, None)
                else:
                    current[part] = path

    def publish(self, now: dt.datetime) -> None:
        """Make all staged changes current at once, by the list of a new version."""
        if not self._pending:
            return
        rows = [(table, part, path, now) for table, slices in self._slices.items() for part, path in slices.items()]
        current = self.spark.createDataFrame(rows, _CURRENT).coalesce(1)
        current.write.mode("errorifexists").parquet(self._list(self.version + 1))
        self.version += 1
        changes, self._pending = self._pending, {}
        if self.catalog is not None:
            self.register(changes)

    def discard(self) -> None:
        """Forget staged changes and return to the published state."""
        self._pending = {}
        self.version, self._slices = self._current()


def staging_path(root: str, table: str) -> str:
    return f"{root}/staging/stg_{table}"


def write_staging(df: DataFrame, root: str, table: str) -> tuple[DataFrame, int]:
    """Replace the staging table of the previous batch; returns it with its row count."""
    path = staging_path(root, table)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]
