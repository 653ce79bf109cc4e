"""Command line of the jobs, for ``spark-submit``. Master and sizes come from the submit.

    spark-submit --py-files shelfcast.zip submit.py forecast --sales ... --folder ...
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.frame import HORIZON_DAYS
from shelfcast.operators.history import of_series
from shelfcast.operators.rollups import in_order, sales_by_month, sales_by_year
from shelfcast.operators.star import MODES
from shelfcast.plans.forecast_job import (
    run_forecast,
    scores_of,
    store_prediction,
    stored_forecast,
)
from shelfcast.plans.star_load import check_star, load_star, read_reports, reset_star
from shelfcast.schemas import FORECAST_TABLE
from shelfcast.sources.claims import holder, release
from shelfcast.sources.commits import last_commit
from shelfcast.sources.grown import as_sales, grow_history, grown_history
from shelfcast.sources.intake import Intake, take_in
from shelfcast.sources.tables import create_table

date = datetime.date.fromisoformat


def days(text: str) -> int:
    number = int(text)
    if number < 0:
        raise argparse.ArgumentTypeError("must not be negative")
    return number


def parser() -> argparse.ArgumentParser:
    commands = argparse.ArgumentParser(description="Store and item demand forecasts")
    add = commands.add_subparsers(dest="command", required=True).add_parser

    rollups = add("rollups", help="store sales by year and by month")
    grow = add("grow", help="add new sales files to the daily history")
    forecast = add("forecast", help="train, predict and score every series, or one")
    for command in (rollups, grow):
        command.add_argument("--sales", required=True, help="CSV files with a header line")
    forecast.add_argument("--sales", help="CSV files; without them the grown history is used")
    forecast.add_argument("--training-date", type=date, default=datetime.date.today())
    forecast.add_argument("--evaluate-before", type=date, default=datetime.date.max)
    forecast.add_argument("--horizon", type=days, default=HORIZON_DAYS)
    forecast.add_argument("--partitions", type=int, help="number of fitting tasks")
    forecast.add_argument("--draws", type=days, default=0, help="sample the band by so many draws")
    forecast.add_argument("--start-from", type=date, help="training date whose models begin the fits")
    forecast.add_argument("--store", type=int)
    forecast.add_argument("--item", type=int)
    forecast.add_argument("--as-float", action="store_true")
    forecast.add_argument("--table", help="name of the forecasts in the catalog")

    predict = add("predict", help="predict from the stored model of a training date")
    predict.add_argument("--training-date", type=date, required=True)
    predict.add_argument("--horizon", type=days, default=HORIZON_DAYS)

    reset = add("reset-star", help="store an empty star schema")
    load = add("load-star", help="load a stored forecast into the star schema")
    load.add_argument("--training-date", type=date, required=True)
    load.add_argument("--mode", choices=MODES, default="append")

    free = add("release-star", help="take away the claim of a load whose driver was lost")

    check = add("check-star", help="count broken references and repeated keys")

    for command in (rollups, grow, forecast, predict, reset, load, free, check):
        command.add_argument("--folder", required=True, help="shared folder for the results")
    return commands


def _series(store: int | None, item: int | None) -> tuple[int, int] | None:
    if (store is None) != (item is None):
        raise SystemExit("give both --store and --item, or neither")
    return None if store is None else (store, item)


def _intake(spark: SparkSession, options: argparse.Namespace) -> Intake:
    """The rows of the sales files, which are read once; says what cannot be used."""
    intake = take_in(spark, options.sales, f"{options.folder}/intake")
    for row in intake.counts.orderBy("reason").collect():
        print(f"{row['reason']}: {row['rows']}")
    return intake


def _grown(spark: SparkSession, folder: str) -> DataFrame:
    """The history that ``grow`` keeps, as sales rows."""
    history = f"{folder}/history"
    if last_commit(spark, f"{history}/commits").run is None:
        raise SystemExit("give --sales, or run grow before")
    return as_sales(grown_history(spark, history))


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"shelfcast {options.command}").getOrCreate()
    star_folder = f"{options.folder}/star"
    if options.command == "rollups":
        sales = _intake(spark, options).lines
        for name, rows, key in (
            ("sales_by_year", sales_by_year(sales), "year"),
            ("sales_by_month", sales_by_month(sales), "month"),
        ):
            in_order(rows, key).write.mode("overwrite").parquet(f"{options.folder}/{name}")
    elif options.command == "grow":
        grow_history(spark, options.sales, f"{options.folder}/history")
    elif options.command == "forecast":
        series = _series(options.store, options.item)
        run_forecast(
            _intake(spark, options).sales if options.sales else _grown(spark, options.folder),
            options.folder,
            options.training_date,
            options.evaluate_before,
            options.horizon,
            options.as_float,
            series,
            options.partitions,
            options.draws,
            options.start_from,
        )
        if options.table:
            path = f"{options.folder}/forecasts"
            create_table(spark, options.table, path, FORECAST_TABLE)
        if series is not None:
            scores = scores_of(spark, options.folder, options.training_date)
            of_series(scores, *series).show()
    elif options.command == "predict":
        store_prediction(spark, options.folder, options.training_date, options.horizon)
    elif options.command == "reset-star":
        reset_star(spark, star_folder)
    elif options.command == "release-star":
        print(f"held by: {holder(spark, star_folder)}")
        release(spark, star_folder)
    elif options.command == "check-star":
        faults = check_star(spark, star_folder)
        for name, count in faults.items():
            print(f"{name}: {count}")
        if any(faults.values()):
            raise SystemExit("the star schema has faults")
    else:
        rows = stored_forecast(spark, options.folder, options.training_date)
        load = str(options.training_date)
        load_star(rows, star_folder, options.mode, load)
        for name, report in read_reports(spark, star_folder).items():
            print(f"{name}: {report.where(report['load'] == load).count()}")


if __name__ == "__main__":
    main()
