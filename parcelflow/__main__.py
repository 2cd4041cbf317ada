"""Run a job: ``python -m parcelflow etl|forecast|all --root FOLDER --run-date YYYY-MM-DD``."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from parcelflow.plans import etl, forecast


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="parcelflow")
    parser.add_argument("job", choices=["etl", "forecast", "all"])
    parser.add_argument("--root", required=True, help="folder of all stages, visible to the whole cluster")
    parser.add_argument("--state", default="ohio")
    parser.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="last day of the data, if not the run date")
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(f"parcelflow-{options.job}").getOrCreate()
    config = etl.EtlConfig(options.root, options.state, options.run_date, options.as_of or options.run_date)
    if options.job in ("etl", "all"):
        etl.run(spark, config)
    if options.job in ("forecast", "all"):
        forecast.run(spark, forecast.ForecastConfig(config))


if __name__ == "__main__":
    main()
