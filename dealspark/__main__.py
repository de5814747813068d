"""Command-line entry point (``python -m dealspark`` or ``run_job.py``).

    spark-submit --py-files dealspark.zip run_job.py --ledger <table|path> --roster <table|path> \
        --config report.json --out <shared folder> [--begin YYYY-MM-DD] [--end YYYY-MM-DD] \
        [--run-date YYYY-MM-DD] [--format csv|parquet]

or, over the driver's test tables: ``--fixtures /root/testdata/sf0.1`` (whose
configuration is built in; ``--config`` replaces it).

The config file holds the settings of ``ReportConfig`` (``config.from_mapping``)
and, where the source's column names differ, ``ledger_names`` and
``roster_names`` (source name -> job's name).  Failures propagate (non-zero
exit status).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import SparkSession

from .config import from_mapping
from .functions.chart import chart_from_table
from .plans.pipeline import run
from .session import apply_defaults
from .sources.extracts import fixture_view_inputs, table_inputs
from .sources.fixtures import MAIN


def main(argv: list[str] | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="dealspark")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--fixtures", help="folder of the driver's parquet tables")
    src.add_argument("--ledger", help="ledger lines: catalog table or path")
    p.add_argument("--roster", help="principal roster: catalog table or path")
    p.add_argument("--input-format", default="parquet")
    p.add_argument("--config", help="JSON file with the report's settings; required with --ledger")
    p.add_argument("--begin", type=dt.date.fromisoformat, help="replaces the config's")
    p.add_argument("--end", type=dt.date.fromisoformat, help="replaces the config's")
    p.add_argument("--out", required=True)
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--format", choices=("csv", "parquet"), default="csv")
    p.add_argument("--null-label", default=None, help="text written for NULL in the key columns of the two summaries (CSV)")
    p.add_argument("--chart", help="chart of accounts: catalog table or Parquet path (position, account, measures, flat_fee)")
    p.add_argument("--stages", help="shared folder where finished stages are kept, so that a rerun goes on after them")
    p.add_argument("--partition-deals-by-year", action="store_true",
                   help="write the deal output in one folder per ending_year")
    a = p.parse_args(argv)
    if a.ledger and not (a.roster and a.config):
        p.error("--roster and --config are required with --ledger")
    names: dict[str, dict[str, str]] = {}
    cfg = MAIN
    if a.config:
        with open(a.config) as f:
            settings = json.load(f)
        names = {k: settings.pop(k) for k in ("ledger_names", "roster_names") if k in settings}
        cfg = from_mapping(settings)
    cfg = replace(cfg, begin=a.begin or cfg.begin, end=a.end or cfg.end)

    spark = SparkSession.builder.appName("dealspark").getOrCreate()
    apply_defaults(spark)
    if a.chart:
        cfg = replace(cfg, chart=chart_from_table(spark.read.parquet(a.chart) if "/" in a.chart else spark.table(a.chart)))
    inputs = fixture_view_inputs(spark, a.fixtures) if a.fixtures else table_inputs(
        spark, a.ledger, a.roster, a.input_format, **names)
    paths = run(spark, inputs, cfg, a.out, a.run_date, fmt=a.format, null_label=a.null_label,
                partition_deals_by_year=a.partition_deals_by_year, stage_root=a.stages)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
