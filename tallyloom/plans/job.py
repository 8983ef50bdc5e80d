"""The load job: extract, clean, check, load, model, report."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import quality, star
from tallyloom.operators.audit import COMPLETED, EVENTS, FAILED, AuditLog, runs_sql
from tallyloom.operators.integrity import orphan_counts
from tallyloom.operators.quality import CheckResult
from tallyloom.operators.transforms import transform
from tallyloom.plans import live, reports
from tallyloom.plans.store import WHOLE, TableStore, staging_path, write_staging
from tallyloom.schemas import (
    CUSTOMERS, DATA_QUALITY_LOGS, DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT_SALES, PIPELINE_RUNS,
    PRODUCTS, SALES, SOURCE_TYPES, TABLES, TableSpec,
)
from tallyloom.sources.delimited import SEQ, inferred_types, typed
from tallyloom.sources.extract import check_sources, read_source

log = logging.getLogger("tallyloom")

DEFAULT_CONFIG: dict = {
    "pipeline_name": "sales_load",
    "sources": [],
    "destinations": [
        {"source": "sales", "table": "sales", "merge_key": "sale_id"},
        {"source": "products", "table": "products", "merge_key": "product_id"},
        {"source": "customers", "table": "customers", "merge_key": "customer_id"},
    ],
    "quality_checks": {"enabled": True, "threshold": 0.95, "fail_on_error": False},
    "star_schema": True,
    "gold": True,
    "database": "default",
}


class QualityGateFailed(RuntimeError):
    """Too few checks passed for a job that is configured to stop then."""


@dataclass
class RunResult:
    run_id: int
    status: str
    records: int = 0
    error: str | None = None
    undated_sales: int = 0
    gold_error: str | None = None
    quality: dict[str, dict[str, CheckResult]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return self.status == COMPLETED


class SalesJob:
    """One configured job writing under ``root``, a folder all executors share.

    Loaded tables and star schema are published together: a failure before that leaves every
    stored table as it was. Gold is written from the published tables; if that fails the load stands,
    and the result names the failure in ``gold_error``.

    Layers: ``bronze`` holds the sources as text with their arrival order, ``silver`` the cleaned
    tables, ``tables`` the merged ones, ``gold`` the reports.

    Tables are readable by name in the catalog's ``database``, in every session; so are the reports, as views that
    show the tables as they are when read. ``gold`` keeps the reports as of the run.
    """

    def __init__(self, spark: SparkSession, config: Mapping, root: str):
        self.spark = spark
        self.config = {**DEFAULT_CONFIG, **config}
        self.root = root
        self.audit = AuditLog(spark, root)
        self.store = TableStore(spark, root, self.config["database"])
        self.seen: dict[str, dict[tuple[str, str, str], int]] = {}
        self.undated_sales = 0

    def _land(self, layer: str, name: str, table: DataFrame, *counts: Column) -> tuple[DataFrame, dict[str, int]]:
        """Write one table of a layer; returns it with ``counts`` and its rows, counted by the same pass."""
        path = f"{self.root}/{layer}/{name}"
        seen = Observation()
        rows = F.count(F.lit(1)).alias("rows")
        table.observe(seen, rows, *counts).write.mode("overwrite").parquet(path)
        log.info("%s %s: %d rows", layer, name, seen.get["rows"])
        return self.spark.read.schema(table.schema).parquet(path), seen.get

    def register(self) -> None:
        """Make stored, staged and audit tables and the live reports readable by name in every session."""
        self.store.register()
        self._register_audit()
        catalog, database = self.store.catalog, self.config["database"]
        sales, products, customers = (f"{database}.{s.name}" for s in (SALES, PRODUCTS, CUSTOMERS))
        for name, sql in live.REPORTS.items():
            catalog.view(name, sql(sales, products, customers))

    def _register_audit(self) -> None:
        catalog, logs = self.store.catalog, DATA_QUALITY_LOGS
        catalog.publish("run_events", T.StructType.fromDDL(EVENTS), self.audit.folders("run_events"), ())
        catalog.view(PIPELINE_RUNS.name, runs_sql(f"{self.config['database']}.run_events"))
        catalog.publish(logs.name, logs.schema, self.audit.folders(logs.name), ())

    def extract(self) -> dict[str, DataFrame]:
        """Every source as it arrived, stored with its arrival order."""
        check_sources(self.config["sources"])
        self.register()
        landed = {}
        for source in self.config["sources"]:
            try:
                raw = read_source(self.spark, source)
                landed[source["name"]], _ = self._land("bronze", source["name"], raw)
            except Exception:
                log.exception("extraction failed for %s", source["name"])
                raise
        return landed

    def transform(
        self, extracted: dict[str, DataFrame], now: dt.datetime
    ) -> dict[str, DataFrame]:
        """Every source typed, cleaned and stored. Files of no known source get the types their cells have.

        What the quality checks count without a shuffle is counted as the table is written.
        """
        cleaned = {}
        files = {s["name"] for s in self.config["sources"] if s["type"] == "csv"}
        for name, cells in extracted.items():
            types = SOURCE_TYPES.get(name)
            if types is None:
                types = inferred_types(cells) if name in files else {}
            table = transform(name, typed(cells, types), now)
            counts = quality.counted(table, name, now)
            cleaned[name], seen = self._land("silver", name, table, *quality.observation(counts))
            self.seen[name] = quality.observed(counts, seen)
        return cleaned

    def check(
        self, cleaned: dict[str, DataFrame], run_id: int, now: dt.datetime
    ) -> dict[str, dict[str, CheckResult]]:
        """Run and log the quality checks; a failed gate stops the job only if configured so."""
        settings = self.config["quality_checks"]
        results: dict[str, dict[str, CheckResult]] = {}
        if not settings.get("enabled", True):
            return results
        rows = None
        for name, table in cleaned.items():
            results[name] = quality.validate(table, name, now, self.seen.get(name))
            logged = quality.log_rows(self.spark, name, results[name])
            rows = logged if rows is None else rows.unionByName(logged)
            log.info("%s\n%s", name, quality.report_text(results[name]))
        if rows is not None:
            self.audit.log_checks(run_id, rows, now)
            verdict = quality.gate(rows, settings.get("threshold", 0.0)).first()
            if settings.get("fail_on_error") and not verdict["accepted"]:
                raise QualityGateFailed(
                    f"{verdict['passed_checks']}/{verdict['total_checks']} checks passed, "
                    f"threshold {settings['threshold']}"
                )
        return results

    def load(self, cleaned: dict[str, DataFrame], now: dt.datetime) -> int:
        """Merge or append every destination; returns the rows loaded. Nothing is published yet."""
        total = 0
        for destination in self.config["destinations"]:
            source, name = destination["source"], destination["table"]
            if source not in cleaned:
                continue
            key = destination.get("merge_key")
            spec = TABLES.get(name) or self.store.open_spec(name, cleaned[source].drop(SEQ), key)
            if key and key != spec.primary_key:
                raise ValueError(f"{name} merges on {spec.primary_key}, not on {key}")
            batch = cleaned[source].select(*[
                F.col(c).cast(spec.schema[c].dataType).alias(c) for c in spec.load_columns
            ], SEQ)
            folder = f"{self.root}/staging/{uuid.uuid4().hex}"
            staged, rows = write_staging(batch, folder, name)
            self.store.catalog.publish(f"stg_{name}", staged.schema, {WHOLE: staging_path(folder, name)})
            if key:
                changed = self.store.upsert(spec, staged, SEQ, now)
            else:
                changed = self.store.append(spec, staged.drop(SEQ), now)
            self.store.stage({name: changed})
            total += rows
            log.info("loaded %d rows to %s", rows, name)
        return total

    def build_star(self, now: dt.datetime) -> None:
        """Bring dimensions and fact up to date with the staged load.

        Facts are rebuilt for the months of sales this load has changed, under new keys; the others
        keep the versions they were loaded with. Sales without a date have no fact; ``undated_sales``
        counts those of the changed months.
        """
        for spec, table, key, tracked in (
            (DIM_PRODUCT, PRODUCTS, "product_id", star.PRODUCT_TRACKED),
            (DIM_CUSTOMER, CUSTOMERS, "customer_id", star.CUSTOMER_TRACKED),
        ):
            merged = star.scd2_merge(
                self.store.read(spec, digest=True), self.store.read(table), spec.primary_key, key, tracked, now.date()
            )
            self.store.stage({spec.name: self.store.write_whole(spec, merged)})
        months = self.store.staged_months(SALES)
        if not months:
            return
        changed = self.store.read(SALES, months)
        self.undated_sales = changed.filter("sale_date IS NULL").count()
        if self.undated_sales:
            log.warning("%d sales without a date have no fact", self.undated_sales)
        sales = changed.filter("sale_date IS NOT NULL")
        known = self.store.read(DIM_DATE)
        dates = star.date_dimension(sales, self._holidays())
        dates = known.unionByName(dates.join(known.select("date_key"), "date_key", "left_anti"))
        self.store.stage({DIM_DATE.name: self.store.write_whole(DIM_DATE, dates)})
        last_key = self.store.read(FACT_SALES).agg(F.max("sales_key")).first()[0] or 0
        fact = star.keyed_fact(
            sales, self.store.read(DIM_PRODUCT), self.store.read(DIM_CUSTOMER), now, after=last_key
        )
        self.store.stage({FACT_SALES.name: self.store.replace_months(FACT_SALES, fact, months)})

    def _holidays(self) -> DataFrame | None:
        """The configured list of ISO dates, a few per year."""
        if self.config.get("holidays") is None:
            return None
        days = [(dt.date.fromisoformat(day),) for day in self.config["holidays"]]
        return self.spark.createDataFrame(days, "full_date date")

    def reports(self) -> dict[str, DataFrame]:
        """Every report over the stored tables, whose keys the load has enforced."""
        sales, products, customers = (self.store.read(s) for s in (SALES, PRODUCTS, CUSTOMERS))
        return {
            "sales_summary": reports.sales_summary(sales, products, customers, sale_id_unique=True),
            "product_performance": reports.product_performance(sales, products, sale_id_unique=True),
            "sales_metrics": reports.sales_metrics(sales, products, sale_id_unique=True),
            "dynamic_report": reports.dynamic_report(sales, products, customers, sale_id_unique=True),
            "data_quality_report": reports.data_quality_report(sales, products, customers),
            "monthly_category_top10": reports.monthly_category_top10(sales, products),
            "orphans": reduce(DataFrame.unionByName, [self.orphans(s) for s in (SALES, FACT_SALES, DATA_QUALITY_LOGS)]),
        }

    def orphans(self, spec: TableSpec) -> DataFrame:
        """Rows of a table whose references no row answers, by reference."""
        audit = {PIPELINE_RUNS.name: self.audit.runs, DATA_QUALITY_LOGS.name: self.audit.logs}
        names = {spec.name, *(r.table for r in spec.references)}
        return orphan_counts(spec, {n: audit[n]() if n in audit else self.store.read(TABLES[n]) for n in names})

    def run(self, now: dt.datetime | None = None) -> RunResult:
        """The whole job. A failure is recorded and returned, not raised."""
        clock = (lambda: now) if now else (lambda: dt.datetime.now().replace(microsecond=0))
        name = self.config["pipeline_name"]
        run_id = self.audit.start(name, clock())
        results: dict[str, dict[str, CheckResult]] = {}
        try:
            cleaned = self.transform(self.extract(), clock())
            results = self.check(cleaned, run_id, clock())
            records = self.load(cleaned, clock())
            if self.config["star_schema"]:
                self.build_star(clock())
            self.store.publish(clock())
        except Exception as failure:
            log.error("run %d failed: %s", run_id, failure)
            self.store.discard()
            self.audit.end(run_id, name, FAILED, 0, clock(), str(failure))
            self._register_audit()
            return RunResult(run_id, FAILED, error=str(failure), quality=results)
        self.audit.end(run_id, name, COMPLETED, records, clock())
        self._register_audit()
        result = RunResult(
            run_id, COMPLETED, records, quality=results, undated_sales=self.undated_sales
        )
        if self.config["gold"]:
            try:
                for report, table in self.reports().items():
                    self._land("gold", report, table)
            except Exception as failure:
                log.exception("run %d is loaded, but its reports failed", run_id)
                result.gold_error = str(failure)
        return result
