"""Run the job from the command line: ``python -m tallyloom config.json folder``.

``config.json`` holds the job's settings, ``folder`` its tables, on storage all executors share.
Afterwards the first rows of the tables and the monthly top ten are shown.
"""

from __future__ import annotations

import json
import logging
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from tallyloom.plans.job import SalesJob
from tallyloom.plans.reports import table_preview
from tallyloom.schemas import CUSTOMERS, PRODUCTS, SALES
from tallyloom.session import SETTINGS


def main(config_path: str, root: str) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    builder = SparkSession.builder.appName("sales load")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    job = SalesJob(spark, json.loads(Path(config_path).read_text()), root)
    result = job.run()
    for spec in (PRODUCTS, CUSTOMERS, SALES):
        table = job.store.read(spec).select(*spec.load_columns)
        table_preview(table, spec.primary_key).show(truncate=False)
    if result and job.config["gold"]:
        spark.table("monthly_category_top10").show(truncate=False)
    print(f"run {result.run_id}: {result.status}, {result.records} rows {result.error or ''}")
    return 0 if result else 1


if __name__ == "__main__":
    if len(sys.argv) != 3:
        sys.exit(__doc__)
    sys.exit(main(sys.argv[1], sys.argv[2]))
