"""

Sales rows come from ``lineitem``: suppliers folded onto 5 stores and parts onto 4 items,
every line used. The dimension loads use one store per supplier and one item per part
instead, so that their size grows with the data.
"""

from __future__ import annotations

import datetime
import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec
from operator import and_

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.season import WAVES
from shelfcast.operators import seasonal, star
from shelfcast.operators.baseline import baseline_forecast
from shelfcast.operators.evaluation import evaluate, evaluate_single, stamp, with_actuals
from shelfcast.operators.frame import extended_history, future_frame, recent_days
from shelfcast.operators.history import (
    clean_history,
    colocate,
    daily_history,
    of_series,
    single_series,
)
from shelfcast.operators.rollups import in_order, sales_by_month, sales_by_year
from shelfcast.operators.sampled import DIGITS as HASH_DIGITS
from shelfcast.operators.sampled import DRAWS, LOWER, UPPER, sampled_horizon
from shelfcast.plans.forecast_job import run_prediction
from shelfcast.plans.star_load import load_star, read_reports, read_star, reset_star
from shelfcast.schemas import EVALUATION, FORECAST_TABLE, PARAMETERS
from shelfcast.sources import views
from shelfcast.sources.grown import grow_history
from shelfcast.sources.intake import take_in
from shelfcast.sources.kept import keep_history
from shelfcast.sources.sales import read_lineitem, read_sales_csv, sales_from_lineitem
from shelfcast.sources.settled import checkpoint_folder, settle
from shelfcast.sources.tables import (
    as_table_rows,
    create_table,
    read_partition,
    save_parameters,
    write_evaluations,
    write_forecasts,
)

# The subpackage and its pipeline may be left out; a fault inside of them is not hidden.
_llm = _pipeline = None
if find_spec("shelfcast.llm") and find_spec("shelfcast.llm.queries"):
    from shelfcast.llm import queries as _llm
if _llm is not None and find_spec("corpus_pipeline") is not None:
    import corpus_pipeline as _pipeline

TRAINING_DATE = datetime.date(2001, 12, 31)
EVALUATE_BEFORE = datetime.date(2001, 1, 1)
# An earlier training saw the sales before this day.
EARLIER_TRAINING = datetime.date(2001, 1, 1)
# A model of the sales before this day, a month ago, begins the next fit.
REFIT_FROM = datetime.date(2001, 10, 5)
# The second load of uneven rows begins here.
SECOND_FROM = datetime.date(2000, 1, 1)
# The first load of the dimensions saw the sales before this day.
FIRST_LOAD = datetime.date(1995, 1, 10)
DIGITS = 4
# How far two searches of one curve may end from each other, as a part of the largest sale.
SAME_CURVE = 0.01
# Bends of the model that a query stores and predicts from.
GIVEN_CHANGES, GIVEN_DELTAS = (0.25, 0.5), (0.3, -0.2)


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lineitem(spark, f"{sf_dir}/lineitem.parquet")


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_lineitem(_lineitem(spark, sf_dir))


def _wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_lineitem(_lineitem(spark, sf_dir), stores=None, items=None)


def _wide_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store for every supplier, so that the number of series grows with the data."""
    lines = _lineitem(spark, sf_dir)
    return clean_history(sales_from_lineitem(lines, stores=None, items=4))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_history(_sales(spark, sf_dir))


def _settled_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read the history several times: the sales are scanned once."""
    return settle(_history(spark, sf_dir))


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({name: F.round(name, DIGITS) for name in columns})


def _rounded_forecast(history: DataFrame) -> DataFrame:
    return _rounded(baseline_forecast(history), "yhat", "yhat_upper", "yhat_lower")


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_forecast(_history(spark, sf_dir))


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(_baseline(spark, sf_dir), TRAINING_DATE)


def _sql(spark: SparkSession, sf_dir: str, text: str, **parameters) -> DataFrame:
    view = views.register(_sales(spark, sf_dir), "daily_sales_rows")
    return views.run_sql(spark, text, sales=view, **parameters)


def _query_single_series(spark, sf_dir):
    return single_series(_sales(spark, sf_dir), store=1, item=1)


def _query_single_series_daily(spark, sf_dir):
    return daily_history(of_series(_sales(spark, sf_dir), store=1, item=1))


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide history as a catalog table that lies by series."""
    name = f"history_{uuid.uuid4().hex}"
    return keep_history(_wide_history(spark, sf_dir), name, _new_folder(spark))


def _query_evaluate_kept(spark, sf_dir):
    """Forecast and scores of the kept history, which is not moved for either."""
    return _rounded_scores(_kept(spark, sf_dir))


def _query_fit_kept(spark, sf_dir):
    """Models of the kept history, as far as they follow from the series alone."""
    return _fit_facts(seasonal.fit(_kept(spark, sf_dir)))


def _query_forecast_with_actuals(spark, sf_dir):
    history = _history(spark, sf_dir)
    return with_actuals(_rounded_forecast(history), history)


def _query_evaluate(spark, sf_dir):
    scores = evaluate(_stamped(spark, sf_dir), EVALUATE_BEFORE)
    return _rounded(scores, "mae", "mse", "rmse")


def _query_baseline_wide(spark, sf_dir):
    return _rounded_forecast(_wide_history(spark, sf_dir))


def _query_evaluate_wide(spark, sf_dir):
    return _rounded_scores(_wide_history(spark, sf_dir))


def _rounded_scores(history: DataFrame) -> DataFrame:
    """Scores of a forecast that is not rounded, as means of few rounded numbers often tie."""
    scores = evaluate(stamp(baseline_forecast(history), TRAINING_DATE), EVALUATE_BEFORE)
    return _rounded(scores, "mae", "mse", "rmse")


def _query_evaluate_single(spark, sf_dir):
    scores = evaluate_single(_stamped(spark, sf_dir), 1, 1, EVALUATE_BEFORE)
    return _rounded(scores, "mae", "mse", "rmse")


def _query_dim_date(spark, sf_dir):
    return star.dim_date(future_frame(_history(spark, sf_dir)))


def _query_dim_store(spark, sf_dir):
    return star.dim_store(_history(spark, sf_dir))


def _query_dim_item(spark, sf_dir):
    return star.dim_item(_history(spark, sf_dir))


def _dimensions(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Store and item dimensions as stored tables. A forecast has the series of its history."""
    return settle(star.dim_store(history)), settle(star.dim_item(history))


def _query_fact_sales(spark, sf_dir):
    history = _settled_history(spark, sf_dir)
    return star.fact_sales(_rounded_forecast(history), *_dimensions(history))


def _first_load(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("date") < F.lit(FIRST_LOAD))


def _query_dim_store_increment(spark, sf_dir):
    sales = _wide_sales(spark, sf_dir)
    stored = settle(star.dim_store(_first_load(sales)))
    return stored.unionByName(star.new_stores(stored, sales))


def _query_dim_item_increment(spark, sf_dir):
    sales = _wide_sales(spark, sf_dir)
    stored = settle(star.dim_item(_first_load(sales)))
    return stored.unionByName(star.new_items(stored, sales))


def _query_dim_date_increment(spark, sf_dir):
    sales = _wide_sales(spark, sf_dir)
    stored = settle(star.dim_date(_first_load(sales), "date"))
    return stored.unionByName(star.new_dates(stored, sales, "date"))


def _merged(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    history = _settled_history(spark, sf_dir)
    stores, items = _dimensions(history)
    earlier = history.where(F.col("ds") < F.lit(EARLIER_TRAINING))
    stored = star.fact_sales(_rounded_forecast(earlier), stores, items)
    batch = star.fact_sales(_rounded_forecast(history), stores, items)
    return star.merged_facts(stored, batch, mode)


def _query_fact_orphans(spark, sf_dir):
    """Facts checked against dimensions without the last store, the last item and the last year."""
    history = _settled_history(spark, sf_dir)
    earlier = history.where(F.col("ds") < F.lit(EARLIER_TRAINING))
    stores, items = _dimensions(history)
    fact = star.fact_sales(_rounded_forecast(history), stores, items)
    dates = settle(star.dim_date(earlier))
    return star.fact_orphans(fact, stores.where("store < 5"), items.where("item < 4"), dates)


def _query_forecast_store_item(spark, sf_dir):
    return seasonal.forecast(_history(spark, sf_dir))


def _query_skipped_series(spark, sf_dir):
    """Most pairs of a supplier and a part have sales on one day only."""
    return seasonal.skipped_series(_wide_sales(spark, sf_dir), "date")


def _query_forecast_single_series(spark, sf_dir):
    one = of_series(_sales(spark, sf_dir), store=1, item=1)
    return seasonal.forecast(clean_history(one))


def _query_fit_params(spark, sf_dir):
    return seasonal.fit(colocate(_history(spark, sf_dir)))


def _query_predict_from_params(spark, sf_dir):
    """Stored-model use: the frame carries dates only, no observed sales."""
    history = colocate(_settled_history(spark, sf_dir))
    frame = extended_history(history).drop("y")
    return seasonal.predict(seasonal.fit(history), frame)


def _query_forecast_checked(spark, sf_dir):
    """What can be said of every series' forecast without the model's own numbers."""
    forecast = seasonal.forecast(_settled_history(spark, sf_dir))
    return _checked(forecast)


def _checked(forecast: DataFrame) -> DataFrame:
    numbers = ("yhat", "yhat_upper", "yhat_lower")
    finite = reduce(and_, [F.abs(name) < 1e300 for name in numbers])
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    error = F.avg((F.col("y") - F.col("yhat")) * (F.col("y") - F.col("yhat")))
    return forecast.groupBy("store", "item").agg(
        F.count("y").alias("points"),
        F.sum(F.col("y").isNull().cast("int")).alias("ahead"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.sum("y").alias("y"),
        F.bool_and(finite & ordered).alias("ordered"),
        (error <= F.var_pop("y") * (1 + 1e-9) + 1e-9).alias("better_than_mean"),
    )


def _query_forecast_series_kept(spark, sf_dir):
    """Many short series, those of one day too: none is lost and all reach the horizon."""
    sales = sales_from_lineitem(_lineitem(spark, sf_dir), stores=100, items=100)
    forecast = seasonal.forecast(settle(clean_history(sales)))
    return forecast.groupBy("store", "item").agg(
        F.count("y").alias("points"),
        F.sum(F.col("y").isNull().cast("int")).alias("ahead"),
        F.max("ds").alias("last_ds"),
    )


def _query_fit_params_checked(spark, sf_dir):
    """The parts of a model that follow from its series alone."""
    return _fit_facts(seasonal.fit(colocate(_history(spark, sf_dir))))


def _fit_facts(parameters: DataFrame) -> DataFrame:
    return parameters.select(
        "store",
        "item",
        "first_ds",
        "last_ds",
        "points",
        "scale",
        F.size("changepoints").alias("changes"),
        F.size("season").alias("waves"),
        (F.col("sigma") >= 0).alias("noise"),
    )


def _query_refit_checked(spark, sf_dir):
    """Models of the whole history, begun anew and begun with those of the earlier history."""
    folded = _history(spark, sf_dir).selectExpr("-store AS store", "item", "ds", "y")
    history = settle(_wide_history(spark, sf_dir).unionByName(folded))
    anew = settle(seasonal.fit(colocate(history)))
    earlier = history.where(F.col("ds") < F.lit(REFIT_FROM))
    again = settle(seasonal.fit(colocate(history), settle(seasonal.fit(colocate(earlier)))))
    curves = [
        seasonal.predict(model, history).select("store", "item", "ds", F.col("yhat").alias(name))
        for name, model in (("anew", anew), ("again", again))
    ]
    both = curves[0].join(curves[1], ["store", "item", "ds"])
    apart = both.groupBy("store", "item").agg(F.max(F.abs(F.expr("anew - again"))).alias("apart"))
    anew_rounds, again_rounds = (model.agg(F.sum("rounds")).first()[0] for model in (anew, again))
    return again.join(apart, ["store", "item"]).select(
        "store",
        "item",
        "points",
        "converged",
        (F.col("apart") <= SAME_CURVE * F.col("scale")).alias("same_curve"),
        F.lit(again_rounds < anew_rounds).alias("fewer_rounds"),
    )


def _given_parameters(history: DataFrame) -> DataFrame:
    """A model as it could be stored: line by regression, fixed bends and waves."""
    fixed = {
        "changepoints": F.array(*map(F.lit, GIVEN_CHANGES)),
        "deltas": F.array(*map(F.lit, GIVEN_DELTAS)),
        "season": F.array(*[F.lit(0.001 * (wave + 1)) for wave in range(len(WAVES))]),
        "sigma": F.lit(0.1),
        "converged": F.lit(True),
        "rounds": F.lit(1),
    }
    days = F.unix_date("ds").cast("double")
    return (
        history.groupBy("store", "item")
        .agg(
            F.min("ds").alias("first_ds"),
            F.max("ds").alias("last_ds"),
            F.count("*").cast("int").alias("points"),
            F.lit(10.0).alias("scale"),
            F.regr_slope("y", days).alias("slope"),
            (F.avg("y") / 10).alias("level"),
        )
        .withColumns(fixed)
        .to(PARAMETERS)
    )


def _query_predict_given_params(spark, sf_dir):
    """Prediction from a stored model: saved, loaded, and joined to dates only."""
    history = _settled_history(spark, sf_dir)
    folder = _new_folder(spark)
    save_parameters(_given_parameters(history), TRAINING_DATE, f"{folder}/parameters")
    predicted = run_prediction(spark, folder, TRAINING_DATE, history.drop("y"))
    return _rounded(predicted, "yhat", "yhat_upper", "yhat_lower").drop("y")


def _query_sampled_bands(spark, sf_dir):
    """Bands of the horizon by 1,000 draws of trend changes for each series."""
    parameters = settle(_given_parameters(_history(spark, sf_dir)))
    return _rounded(sampled_horizon(parameters), "yhat", "yhat_upper", "yhat_lower").drop("y")


def _new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"


def _query_csv_source(spark, sf_dir):
    """Sales written as CSV with a header and read again."""
    folder = _new_folder(spark)
    _sales(spark, sf_dir).write.option("header", True).csv(folder)
    return read_sales_csv(spark, folder)


def _faulty_files(spark: SparkSession, sf_dir: str) -> str:
    """Sales files with a header line each, and lines of every fault by the order line."""
    sales = _lineitem(spark, sf_dir).select(
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_suppkey") % 5 + 1).alias("store"),
        (F.col("l_partkey") % 4 + 1).alias("item"),
        F.col("l_quantity").cast("int").alias("sales"),
        F.col("l_partkey").alias("part"),
    )
    fields = [F.col(name).cast("string") for name in ("date", "store", "item", "sales")]
    date, store, item, sold = fields
    part = F.col("part") % 40
    line = (
        F.when(part == 1, F.concat_ws(",", F.date_format("date", "dd.MM.yyyy"), store, item, sold))
        .when(part == 2, F.concat_ws(",", date, store, item, sold, F.lit("more")))
        .when(part == 3, F.concat_ws(",", date, store, item))
        .when(part == 4, F.lit(""))
        .when(part == 5, F.concat_ws(",", date, F.lit("north"), item, F.lit("many")))
        .when(part == 6, F.concat_ws(",", date, store, item, F.lit("")))
        .when(part == 7, F.concat_ws(",", date, F.lit(""), item, sold))
        .when(part == 8, F.concat_ws(",", date, store, F.lit("9999999999"), sold))
        .otherwise(F.concat_ws(",", *fields))
    )
    folder = _new_folder(spark)
    # A single column whose text is the line: no character of it is quoted.
    written = sales.select(line.alias("date,store,item,sales")).write.option("header", True)
    written.options(sep="\t", quote="\u0000", emptyValue="").csv(folder)
    return folder


def _intake(spark: SparkSession, sf_dir: str):
    return take_in(spark, _faulty_files(spark, sf_dir), _new_folder(spark))


def _query_history_grown(spark, sf_dir):
    """Files of the first years, a draft of the later ones, and at last the draft replaced."""
    sales, folder = _sales(spark, sf_dir), _new_folder(spark)
    later = F.col("date") >= F.lit(SECOND_FROM)
    draft = sales.where(later).withColumn("sales", F.col("sales") + 1)
    batches = {"first": sales.where(~later), "draft": draft, "final": sales.where(later)}
    for name, rows in batches.items():
        rows.write.option("header", True).csv(f"{folder}/sales/{name}")
    for names in ("first", "{first,draft}", "{first,final}"):
        grown = grow_history(spark, f"{folder}/sales/{names}", f"{folder}/history")
    return grown


def _query_forecasts_table_stored(spark, sf_dir):
    """Two training dates stored, one of them again, and read as a catalog table."""
    forecast, folder = settle(_baseline(spark, sf_dir)), _new_folder(spark)
    for date in (TRAINING_DATE, EARLIER_TRAINING, TRAINING_DATE):
        write_forecasts(stamp(forecast, date), folder)
    name = f"forecasts_{uuid.uuid4().hex}"
    create_table(spark, name, folder, FORECAST_TABLE)
    return views.read_view(spark, name)


def _query_evaluations_stored(spark, sf_dir):
    folder = _new_folder(spark)
    for _ in range(2):
        write_evaluations(_query_evaluate(spark, sf_dir), folder)
    return read_partition(spark, folder, EVALUATION, TRAINING_DATE).select(EVALUATION.names)


def _query_evaluate_from_view(spark, sf_dir):
    views.register(_stamped(spark, sf_dir), "stamped_forecast")
    scores = evaluate(views.read_view(spark, "stamped_forecast"), EVALUATE_BEFORE)
    return _rounded(scores, "mae", "mse", "rmse")


def _query_star_loaded(spark, sf_dir):
    """An earlier batch loaded, the whole one appended twice and then replaced."""
    history, folder = _settled_history(spark, sf_dir), _new_folder(spark)
    earlier = history.where(F.col("ds") < F.lit(EARLIER_TRAINING))
    rows = settle(_rounded_forecast(history))
    reset_star(spark, folder)
    load_star(settle(_rounded_forecast(earlier)), folder)
    for mode in ("append", "append", "replace"):
        load_star(rows, folder, mode)
    return read_star(spark, folder)["fact_sales"]


def _uneven_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as forecast rows: most keys come again, some stores and items are missing."""
    key = (F.col("l_partkey") % 5 + 1).cast("int")
    rows = _lineitem(spark, sf_dir).withColumn("sold", F.col("l_quantity").cast("int"))
    return rows.select(
        F.col("l_shipdate").cast("date").alias("ds"),
        F.when(F.col("sold") % 11 != 0, (F.col("l_suppkey") % 5 + 1).cast("int")).alias("store"),
        F.when(F.col("sold") % 13 != 0, key).alias("item"),
        F.col("l_quantity").alias("y"),
        F.col("l_partkey").cast("double").alias("yhat"),
        (F.col("l_partkey") + 1).cast("double").alias("yhat_upper"),
        (F.col("l_partkey") - 1).cast("double").alias("yhat_lower"),
    )


def _uneven_loads(spark: SparkSession, sf_dir: str, mode: str, add_members: bool) -> str:
    """A first load without the last item and the last years, and a second one that has them."""
    rows, folder = settle(_uneven_rows(spark, sf_dir)), _new_folder(spark)
    reset_star(spark, folder)
    first = (F.col("ds") < F.lit(EARLIER_TRAINING)) & (F.col("item").isNull() | (F.col("item") < 5))
    load_star(rows.where(first), folder, load="first")
    later = rows.where(F.col("ds") >= F.lit(SECOND_FROM))
    load_star(later, folder, mode, "second", ("yhat",), add_members)
    return folder


def _query_star_rejects(spark, sf_dir):
    """Rows that the second load refused, as it may not add members."""
    folder = _uneven_loads(spark, sf_dir, "append", add_members=False)
    return read_reports(spark, folder)["rejected_facts"].where("load = 'second'")


def _query_star_uneven(mode: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _uneven_loads(spark, sf_dir, mode, add_members=True)
        return read_star(spark, folder)["fact_sales"]

    return query


def _query_star_repeats(spark, sf_dir):
    """Keys that came again within the second load."""
    folder = _uneven_loads(spark, sf_dir, "replace", add_members=True)
    return read_reports(spark, folder)["repeated_facts"].where("load = 'second'")


def _query_months_in_order(spark, sf_dir):
    """The month rollup with its place in the sorted output."""
    rows = in_order(sales_by_month(_sales(spark, sf_dir)), "month").coalesce(1)
    return rows.withColumn("place", F.monotonically_increasing_id())


def entry(spark: SparkSession) -> DataFrame:
    """Seasonal forecast of every store and item on the smallest tables."""
    return _query_forecast_store_item(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "train_source": _sales,
        "single_series": _query_single_series,
        "single_series_daily": _query_single_series_daily,
        "sales_by_year": lambda spark, sf_dir: sales_by_year(_sales(spark, sf_dir)),
        "sales_by_month": lambda spark, sf_dir: sales_by_month(_sales(spark, sf_dir)),
        "sql_year_sales": lambda spark, sf_dir: _sql(spark, sf_dir, views.YEAR_SALES),
        "sql_month_sales": lambda spark, sf_dir: _sql(spark, sf_dir, views.MONTH_SALES),
        "sql_daily_sales": lambda spark, sf_dir: _sql(spark, sf_dir, views.DAILY_SALES),
        "sql_series_sales": lambda spark, sf_dir: _sql(
            spark, sf_dir, views.SERIES_SALES, store=1, item=1
        ),
        "store_item_history": lambda spark, sf_dir: daily_history(_sales(spark, sf_dir)),
        "clean_history": _history,
        "future_frame": lambda spark, sf_dir: future_frame(_history(spark, sf_dir)),
        "baseline_forecast": _baseline,
        "forecast_with_actuals": _query_forecast_with_actuals,
        "evaluate": _query_evaluate,
        "baseline_forecast_wide": _query_baseline_wide,
        "evaluate_wide": _query_evaluate_wide,
        "history_kept": _kept,
        "evaluate_kept": _query_evaluate_kept,
        "fit_kept_checked": _query_fit_kept,
        "evaluate_single": _query_evaluate_single,
        "plot_window": lambda spark, sf_dir: recent_days(_baseline(spark, sf_dir)),
        "forecasts_table": lambda spark, sf_dir: as_table_rows(_stamped(spark, sf_dir)),
        "dim_date": _query_dim_date,
        "dim_store": _query_dim_store,
        "dim_item": _query_dim_item,
        "fact_sales": _query_fact_sales,
        "dim_store_increment": _query_dim_store_increment,
        "dim_item_increment": _query_dim_item_increment,
        "dim_date_increment": _query_dim_date_increment,
        "fact_increment": lambda spark, sf_dir: _merged(spark, sf_dir, "append"),
        "fact_replace": lambda spark, sf_dir: _merged(spark, sf_dir, "replace"),
        "fact_orphans": _query_fact_orphans,
        "skipped_series": _query_skipped_series,
        "forecast_store_item": _query_forecast_store_item,
        "forecast_single_series": _query_forecast_single_series,
        "fit_params": _query_fit_params,
        "predict_from_params": _query_predict_from_params,
        "forecast_checked": _query_forecast_checked,
        "forecast_series_kept": _query_forecast_series_kept,
        "fit_params_checked": _query_fit_params_checked,
        "predict_given_params": _query_predict_given_params,
        "sampled_bands": _query_sampled_bands,
        "refit_checked": _query_refit_checked,
        "csv_source": _query_csv_source,
        "csv_taken": lambda spark, sf_dir: _intake(spark, sf_dir).sales,
        "csv_refused": lambda spark, sf_dir: _intake(spark, sf_dir).refused,
        "csv_counts": lambda spark, sf_dir: _intake(spark, sf_dir).counts,
        "history_grown": _query_history_grown,
        "forecasts_table_stored": _query_forecasts_table_stored,
        "evaluations_stored": _query_evaluations_stored,
        "evaluate_from_view": _query_evaluate_from_view,
        "star_loaded": _query_star_loaded,
        "star_rejects": _query_star_rejects,
        "star_uneven_append": _query_star_uneven("append"),
        "star_uneven_replace": _query_star_uneven("replace"),
        "star_repeats": _query_star_repeats,
        "months_in_order": _query_months_in_order,
    } | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    pipeline = {} if _pipeline is None else {"pipeline": _pipeline.run}
    return {} if _llm is None else {**_llm.queries(), **pipeline}


def _llm_sql() -> dict[str, str]:
    if _llm is None:
        return {}
    sql = None if _pipeline is None else _pipeline.ORACLE_SQL
    pipeline = {} if sql is None else {"pipeline": sql}
    return {**_llm.oracle_sql(), **pipeline}


# --- The same in SQL. Each text is a WITH list and a final SELECT. ---

_SALES_SQL = """
sales_rows AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % 5 + 1 AS INT) AS store,
         CAST(l_partkey % 4 + 1 AS INT) AS item, CAST(l_quantity AS INT) AS sales
  FROM lineitem)"""

_WIDE_SALES_SQL = """
sales_rows AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey + 1 AS INT) AS store,
         CAST(l_partkey + 1 AS INT) AS item
  FROM lineitem)"""

_HISTORY_SQL = _SALES_SQL + """,
history AS (
  SELECT store, item, date AS ds, CAST(SUM(sales) AS BIGINT) AS y
  FROM sales_rows
  WHERE date IS NOT NULL AND store IS NOT NULL AND item IS NOT NULL AND sales IS NOT NULL
  GROUP BY store, item, date)"""


def _baseline_sql(name: str, history: str) -> str:
    """CTEs ending in ``name``, the rounded baseline forecast of a history relation."""
    p = f"{name}_"
    return f"""
{p}last AS (SELECT store, item, MAX(ds) AS last FROM {history} GROUP BY store, item),
{p}frame AS (
  SELECT store, item, ds, y FROM {history}
  UNION ALL
  SELECT store, item, CAST(last + CAST(i AS INT) AS DATE), CAST(NULL AS BIGINT)
  FROM {p}last, range(1, 91) r(i)),
{p}days AS (
  SELECT store, item, ds, y, CAST(datediff('day', DATE '1970-01-01', ds) AS DOUBLE) AS t,
         isodow(ds) AS dow
  FROM {p}frame),
{p}trend AS (
  SELECT store, item, CASE WHEN COUNT(y) > 1 THEN regr_slope(y, t) ELSE 0 END AS b,
         CASE WHEN COUNT(y) > 1 THEN regr_intercept(y, t) ELSE AVG(y) END AS a
  FROM {p}days WHERE y IS NOT NULL GROUP BY store, item),
{p}placed AS (
  SELECT d.*, a + b * t AS g FROM {p}days d JOIN {p}trend USING (store, item)),
{p}week AS (
  SELECT store, item, dow, AVG(CASE WHEN abs(g) > 1e-9 THEN y / g END) AS factor
  FROM {p}placed WHERE y IS NOT NULL GROUP BY store, item, dow),
{p}center AS (
  SELECT c.store, c.item, ds, y, g * COALESCE(factor, 1) AS yhat
  FROM {p}placed c LEFT JOIN {p}week w
    ON c.store = w.store AND c.item = w.item AND c.dow = w.dow),
{p}spread AS (
  SELECT store, item, 1.959963984540054 * COALESCE(STDDEV_SAMP(y - yhat), 0) AS band
  FROM {p}center WHERE y IS NOT NULL GROUP BY store, item),
{name} AS (
  SELECT ds, store, item, CAST(y AS DOUBLE) AS y, ROUND(yhat, 4) AS yhat,
         ROUND(yhat + band, 4) AS yhat_upper, ROUND(yhat - band, 4) AS yhat_lower
  FROM {p}center JOIN {p}spread USING (store, item))"""


_FORECAST_SQL = _HISTORY_SQL + "," + _baseline_sql("forecast", "history")

_SCORES_SQL = f"""
SELECT DATE '{TRAINING_DATE}' AS training_date, store, item,
       ROUND(AVG(abs(y - yhat)), 4) AS mae, ROUND(AVG((y - yhat) * (y - yhat)), 4) AS mse,
       ROUND(sqrt(AVG((y - yhat) * (y - yhat))), 4) AS rmse
FROM forecast WHERE ds < DATE '{EVALUATE_BEFORE}' {{condition}}
GROUP BY store, item"""

_DIMS_SQL = """
dim_store AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY store) AS INT) AS id, store
  FROM (SELECT DISTINCT store FROM history) s),
dim_item AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY item) AS INT) AS id, item
  FROM (SELECT DISTINCT item FROM history) i)"""


def _fact_sql(name: str, forecast: str) -> str:
    return f"""
{name} AS (
  SELECT s.id AS store_id, ds AS date_id, i.id AS item_id, y AS sales, yhat AS sales_predicted,
         yhat_upper AS sales_predicted_upper, yhat_lower AS sales_predicted_lower
  FROM {forecast} f JOIN dim_store s ON f.store = s.store JOIN dim_item i ON f.item = i.item)"""


_FACT_SQL = f"{_FORECAST_SQL},{_DIMS_SQL},{_fact_sql('fact', 'forecast')}"

_EARLIER_SQL = f"""
earlier AS (SELECT * FROM history WHERE ds < DATE '{EARLIER_TRAINING}')"""

_TWO_FACTS_SQL = ",".join(
    [
        _FACT_SQL,
        _EARLIER_SQL,
        _baseline_sql("earlier_forecast", "earlier"),
        _fact_sql("stored_fact", "earlier_forecast"),
    ]
)

_SAME_KEY = "k.store_id = f.store_id AND k.date_id = f.date_id AND k.item_id = f.item_id"


def _merge_sql(kept: str, other: str) -> str:
    return f"""
SELECT * FROM {kept}
UNION ALL
SELECT * FROM {other} f WHERE NOT EXISTS (SELECT 1 FROM {kept} k WHERE {_SAME_KEY})"""


# Two uneven loads. Ids of the second one follow those of the first.
_UNEVEN_SQL = f"""
uneven AS (
  SELECT CAST(l_shipdate AS DATE) AS ds,
         CASE WHEN CAST(l_quantity AS INT) % 11 <> 0 THEN CAST(l_suppkey % 5 + 1 AS INT) END AS store,
         CASE WHEN CAST(l_quantity AS INT) % 13 <> 0 THEN CAST(l_partkey % 5 + 1 AS INT) END AS item,
         l_quantity AS y, CAST(l_partkey AS DOUBLE) AS yhat
  FROM lineitem),
first_rows AS (
  SELECT * FROM uneven WHERE ds < DATE '{EARLIER_TRAINING}' AND (item IS NULL OR item < 5)),
second_rows AS (SELECT * FROM uneven WHERE ds >= DATE '{SECOND_FROM}'),
known_stores AS (
  SELECT store, MIN(load) AS load FROM (
    SELECT store, 1 AS load FROM first_rows UNION ALL SELECT store, 2 FROM second_rows) s
  WHERE store IS NOT NULL GROUP BY store),
known_items AS (
  SELECT item, MIN(load) AS load FROM (
    SELECT item, 1 AS load FROM first_rows UNION ALL SELECT item, 2 FROM second_rows) s
  WHERE item IS NOT NULL GROUP BY item),
uneven_stores AS (
  SELECT store, CAST(ROW_NUMBER() OVER (ORDER BY load, store) AS INT) AS store_id FROM known_stores),
uneven_items AS (
  SELECT item, CAST(ROW_NUMBER() OVER (ORDER BY load, item) AS INT) AS item_id FROM known_items),
first_facts AS (
  SELECT store_id, ds AS date_id, item_id, MIN(ROW(y, yhat)) AS m, COUNT(*) AS n
  FROM first_rows JOIN uneven_stores USING (store) JOIN uneven_items USING (item)
  WHERE ds IS NOT NULL GROUP BY store_id, ds, item_id),
second_facts AS (
  SELECT store_id, ds AS date_id, item_id, arg_min(ROW(y, yhat), ROW(yhat, y)) AS early,
         arg_max(ROW(y, yhat), ROW(yhat, y)) AS late, COUNT(*) AS n
  FROM second_rows JOIN uneven_stores USING (store) JOIN uneven_items USING (item)
  WHERE ds IS NOT NULL GROUP BY store_id, ds, item_id)"""


def _uneven_facts_sql(chosen: str) -> str:
    return f"""WITH {_UNEVEN_SQL},
both_loads AS (
  SELECT store_id, date_id, item_id, {chosen} AS m
  FROM first_facts FULL JOIN second_facts USING (store_id, date_id, item_id))
SELECT store_id, date_id, item_id, m[1] AS sales, m[2] AS sales_predicted,
       m[2] + 1 AS sales_predicted_upper, m[2] - 1 AS sales_predicted_lower
FROM both_loads"""


_REJECTS_SQL = f"""WITH {_UNEVEN_SQL},
judged AS (
  SELECT *, array_to_string([x FOR x IN [
           CASE WHEN store IS NULL THEN 'store is missing'
                WHEN store NOT IN (SELECT store FROM known_stores WHERE load = 1)
                THEN 'store is unknown' END,
           CASE WHEN item IS NULL THEN 'item is missing'
                WHEN item NOT IN (SELECT item FROM known_items WHERE load = 1)
                THEN 'item is unknown' END,
           CASE WHEN ds IS NULL THEN 'date is missing'
                WHEN ds NOT IN (SELECT ds FROM first_rows WHERE ds IS NOT NULL)
                THEN 'date is unknown' END] IF x IS NOT NULL], ', ') AS reason
  FROM second_rows)
SELECT ds, store, item, y, yhat, yhat + 1 AS yhat_upper, yhat - 1 AS yhat_lower, reason,
       'second' AS load
FROM judged WHERE reason <> ''"""


def _dim_increment_sql(key: str) -> str:
    return f"""
WITH {_WIDE_SALES_SQL},
stored AS (
  SELECT ROW_NUMBER() OVER (ORDER BY {key}) AS id, {key}
  FROM (SELECT DISTINCT {key} FROM sales_rows WHERE date < DATE '{FIRST_LOAD}') k),
added AS (
  SELECT (SELECT MAX(id) FROM stored) + ROW_NUMBER() OVER (ORDER BY {key}) AS id, {key}
  FROM (SELECT DISTINCT {key} FROM sales_rows
        WHERE {key} NOT IN (SELECT {key} FROM stored)) k)
SELECT CAST(id AS INT) AS id, {key} FROM stored
UNION ALL
SELECT CAST(id AS INT) AS id, {key} FROM added"""


_DATE_PARTS = """
CAST(day(date) AS INT) AS day, CAST(month(date) AS INT) AS month, CAST(year(date) AS INT) AS year"""

_YEARS = "CAST(year(date) AS INT) AS year, CAST(SUM(sales) AS BIGINT) AS sales"
_MONTHS = "CAST(date_trunc('month', date) AS DATE) AS month, CAST(SUM(sales) AS BIGINT) AS sales"


_LINES_SQL = f"""{_SALES_SQL},
faulty AS (
  SELECT date, store, item, sales, CAST(l_partkey % 40 AS INT) AS part
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey % 5 + 1 AS INT) AS store,
               CAST(l_partkey % 4 + 1 AS INT) AS item, CAST(l_quantity AS INT) AS sales, l_partkey
        FROM lineitem) r
  WHERE l_partkey % 40 <> 4),
refused_lines AS (
  SELECT CASE WHEN part <> 1 THEN date END AS date,
         CASE WHEN part NOT IN (5, 7) THEN store END AS store,
         CASE WHEN part <> 8 THEN item END AS item,
         CASE WHEN part NOT IN (3, 5, 6) THEN sales END AS sales,
         CASE part WHEN 1 THEN strftime(date, '%d.%m.%Y') || ',' || store || ',' || item || ',' || sales
                   WHEN 2 THEN date || ',' || store || ',' || item || ',' || sales || ',more'
                   WHEN 3 THEN date || ',' || store || ',' || item
                   WHEN 5 THEN date || ',north,' || item || ',many'
                   WHEN 6 THEN date || ',' || store || ',' || item || ','
                   WHEN 7 THEN date || ',,' || item || ',' || sales
                   ELSE date || ',' || store || ',9999999999,' || sales END AS line,
         CASE part WHEN 1 THEN 'date is unreadable' WHEN 2 THEN 'wrong number of fields'
                   WHEN 3 THEN 'wrong number of fields' WHEN 5 THEN 'store is unreadable'
                   WHEN 6 THEN 'sales is missing' WHEN 7 THEN 'store is missing'
                   ELSE 'item is unreadable' END AS reason
  FROM faulty WHERE part IN (1, 2, 3, 5, 6, 7, 8)),
taken AS (
  SELECT date, store, item, sales FROM faulty WHERE part NOT IN (1, 2, 3, 5, 6, 7, 8))"""


def _model_sql() -> str:
    """yhat and band of the given parameters, spelled out."""
    return f"""{_curves_sql()},
banded AS (
  SELECT *, 10 * trend * growth AS center,
         1.959963984540054 * 10 * sqrt(0.1 * 0.1 + growth * growth * variance) AS band
  FROM curved)
SELECT ds, store, item, ROUND(center, 4) AS yhat, ROUND(center + band, 4) AS yhat_upper,
       ROUND(center - band, 4) AS yhat_lower
FROM banded"""


def _sampled_sql() -> str:
    """The draws of the given parameters and their percentiles, spelled out."""
    mean = sum(map(abs, GIVEN_DELTAS)) / len(GIVEN_DELTAS)
    digits = ", ".join(
        f"(CAST('0x' || substr(hash, {first}, {count}) AS BIGINT) + 0.5) / {16**count} AS {name}"
        for name, (first, count) in HASH_DIGITS.items()
    )
    return f"""{_curves_sql()},
hashed AS (
  SELECT c.*, draw, {len(GIVEN_DELTAS)} / CAST(datediff('day', first_ds, last_ds) AS DOUBLE) AS rate,
         md5(concat_ws(':', c.store, c.item, draw, CAST(d AS BIGINT))) AS hash
  FROM curved c JOIN model m ON c.store = m.store AND c.item = m.item,
       range(1, {DRAWS + 1}) r(draw)
  WHERE c.ds > last_ds),
chances AS (SELECT *, {digits} FROM hashed),
changes AS (
  SELECT *, CASE WHEN chance < rate
              THEN -{mean!r} * sign(chance / rate - 0.5) * ln(1 - 2 * abs(chance / rate - 0.5))
              ELSE 0 END AS change,
         0.1 * sqrt(-2 * ln(radius)) * cos(2 * pi() * angle) AS noise
  FROM chances),
bent AS (
  SELECT *, t * SUM(change) OVER so_far - SUM(change * t) OVER so_far AS moved FROM changes
  WINDOW so_far AS (PARTITION BY store, item, draw ORDER BY ds)),
valued AS (SELECT *, 10 * ((trend + moved) * growth + noise) AS value FROM bent)
SELECT ds, store, item, ROUND(ANY_VALUE(10 * trend * growth), 4) AS yhat,
       ROUND(quantile_cont(value, {UPPER}), 4) AS yhat_upper,
       ROUND(quantile_cont(value, {LOWER}), 4) AS yhat_lower
FROM valued GROUP BY ds, store, item"""


def _curves_sql() -> str:
    """CTEs up to trend and growth of the given parameters on every day."""
    season = " + ".join(
        f"{0.001 * (at + 1)!r} * {wave}(d * {angle!r})" for at, (wave, angle) in enumerate(WAVES)
    )
    bends = " + ".join(
        f"{delta} * greatest(t - {change}, 0)" for change, delta in zip(GIVEN_CHANGES, GIVEN_DELTAS)
    )
    size = sum(map(abs, GIVEN_DELTAS)) / len(GIVEN_DELTAS)
    drift = len(GIVEN_DELTAS) * 2 / 3 * size**2
    return f"""WITH {_FORECAST_SQL},
model AS (
  SELECT store, item, MIN(ds) AS first_ds, MAX(ds) AS last_ds,
         regr_slope(y, CAST(datediff('day', DATE '1970-01-01', ds) AS DOUBLE)) AS slope,
         AVG(y) / 10 AS level
  FROM history GROUP BY store, item),
placed AS (
  SELECT f.store, f.item, f.ds, slope, level,
         CAST(datediff('day', DATE '1970-01-01', f.ds) AS DOUBLE) AS d,
         datediff('day', first_ds, f.ds) / CAST(datediff('day', first_ds, last_ds) AS DOUBLE) AS t
  FROM forecast_frame f JOIN model m ON f.store = m.store AND f.item = m.item),
curved AS (
  SELECT *, level + slope * t + {bends} AS trend, 1 + {season} AS growth,
         {drift!r} * pow(greatest(t - 1, 0), 3) AS variance
  FROM placed)"""


def oracle_sql() -> dict[str, str]:
    year = f"WITH {_SALES_SQL} SELECT {_YEARS} FROM sales_rows GROUP BY year(date)"
    month = f"WITH {_SALES_SQL} SELECT {_MONTHS} FROM sales_rows GROUP BY date_trunc('month', date)"
    daily = f"""WITH {_SALES_SQL}
SELECT store, item, date AS ds, CAST(SUM(sales) AS BIGINT) AS y
FROM sales_rows {{condition}} GROUP BY store, item, date"""
    series = f"""WITH {_SALES_SQL}
SELECT date AS ds, sales AS y FROM sales_rows WHERE store = 1 AND item = 1"""
    many = _HISTORY_SQL.replace("% 5 + 1", "% 100 + 1").replace("% 4 + 1", "% 100 + 1")
    first_series = "AND store = 1 AND item = 1"
    folded, own_store = "l_suppkey % 5 + 1", "l_suppkey + 1"
    wide = _FORECAST_SQL.replace(folded, own_store)
    exact = wide
    for rounded in ("yhat", "yhat + band", "yhat - band"):
        exact = exact.replace(f"ROUND({rounded}, 4)", rounded)
    fit_facts = f"""
SELECT store, item, MIN(ds) AS first_ds, MAX(ds) AS last_ds, CAST(COUNT(*) AS INT) AS points,
       CAST(MAX(abs(y)) AS DOUBLE) AS scale,
       CAST(greatest(least(25, CAST(FLOOR(COUNT(*) * 0.8) AS INT) - 1), 0) AS INT) AS changes,
       {len(WAVES)} AS waves, TRUE AS noise
FROM history GROUP BY store, item"""
    return {
        "train_source": f"WITH {_SALES_SQL} SELECT * FROM sales_rows",
        "single_series": series,
        "single_series_daily": daily.format(condition="WHERE store = 1 AND item = 1"),
        "sales_by_year": year,
        "sales_by_month": month,
        "sql_year_sales": year,
        "sql_month_sales": month,
        "sql_daily_sales": daily.format(condition=""),
        "sql_series_sales": series,
        "store_item_history": daily.format(condition=""),
        "clean_history": f"WITH {_HISTORY_SQL} SELECT * FROM history",
        "sampled_bands": _sampled_sql(),
        "refit_checked": f"""WITH {_HISTORY_SQL},
wide AS (
  SELECT CAST(l_suppkey + 1 AS INT) AS store, CAST(l_partkey % 4 + 1 AS INT) AS item,
         CAST(l_shipdate AS DATE) AS ds
  FROM lineitem
  WHERE l_shipdate IS NOT NULL AND l_suppkey IS NOT NULL AND l_partkey IS NOT NULL
    AND l_quantity IS NOT NULL)
SELECT store, item, CAST(COUNT(DISTINCT ds) AS INT) AS points, TRUE AS converged,
       TRUE AS same_curve, TRUE AS fewer_rounds
FROM (SELECT -store AS store, item, ds FROM history UNION ALL SELECT * FROM wide) s
GROUP BY store, item""",
        "history_grown": f"WITH {_HISTORY_SQL} SELECT * FROM history",
        "future_frame": f"WITH {_FORECAST_SQL} SELECT store, item, ds FROM forecast_frame",
        "baseline_forecast": f"WITH {_FORECAST_SQL} SELECT * FROM forecast",
        "forecast_with_actuals": f"""WITH {_FORECAST_SQL}
SELECT f.store, f.item, f.ds, yhat, yhat_upper, yhat_lower, h.y
FROM forecast f LEFT JOIN history h
  ON f.store = h.store AND f.item = h.item AND f.ds = h.ds""",
        "baseline_forecast_wide": f"WITH {wide} SELECT * FROM forecast",
        "evaluate_wide": f"WITH {exact} {_SCORES_SQL.format(condition='')}",
        "evaluate": f"WITH {_FORECAST_SQL} {_SCORES_SQL.format(condition='')}",
        "evaluate_single": f"WITH {_FORECAST_SQL} {_SCORES_SQL.format(condition=first_series)}",
        "plot_window": f"""WITH {_FORECAST_SQL}
SELECT f.* FROM forecast f
JOIN (SELECT store, item, MAX(ds) AS newest FROM forecast GROUP BY store, item) n
  ON f.store = n.store AND f.item = n.item
WHERE ds >= newest - 454""",
        "forecasts_table": f"""WITH {_FORECAST_SQL}
SELECT ds AS date, store, item, y AS sales, yhat AS sales_predicted,
       yhat_upper AS sales_predicted_upper, yhat_lower AS sales_predicted_lower,
       DATE '{TRAINING_DATE}' AS training_date
FROM forecast""",
        "dim_date": f"""WITH {_FORECAST_SQL}
SELECT date, {_DATE_PARTS} FROM (SELECT DISTINCT ds AS date FROM forecast) d""",
        "dim_store": f"WITH {_HISTORY_SQL}, {_DIMS_SQL} SELECT * FROM dim_store",
        "dim_item": f"WITH {_HISTORY_SQL}, {_DIMS_SQL} SELECT * FROM dim_item",
        "fact_sales": f"WITH {_FACT_SQL} SELECT * FROM fact",
        "dim_store_increment": _dim_increment_sql("store"),
        "dim_item_increment": _dim_increment_sql("item"),
        "dim_date_increment": f"""WITH {_WIDE_SALES_SQL}
SELECT date, {_DATE_PARTS} FROM (SELECT DISTINCT date FROM sales_rows) d""",
        "fact_increment": f"WITH {_TWO_FACTS_SQL} {_merge_sql('stored_fact', 'fact')}",
        "fact_replace": f"WITH {_TWO_FACTS_SQL} {_merge_sql('fact', 'stored_fact')}",
        "skipped_series": f"""WITH {_WIDE_SALES_SQL}
SELECT store, item, CAST(COUNT(DISTINCT date) AS INT) AS points,
       'fewer than two days of history' AS reason
FROM sales_rows GROUP BY store, item HAVING COUNT(DISTINCT date) < 2""",
        "forecast_checked": f"""WITH {_HISTORY_SQL}
SELECT store, item, COUNT(*) AS points, CAST(90 AS BIGINT) AS ahead, MIN(ds) AS first_ds,
       CAST(MAX(ds) + 90 AS DATE) AS last_ds, CAST(SUM(y) AS DOUBLE) AS y, TRUE AS ordered,
       TRUE AS better_than_mean
FROM history GROUP BY store, item""",
        "forecast_series_kept": f"""WITH {many}
SELECT store, item, COUNT(*) AS points, CAST(90 AS BIGINT) AS ahead,
       CAST(MAX(ds) + 90 AS DATE) AS last_ds
FROM history GROUP BY store, item""",
        "fit_params_checked": f"WITH {_HISTORY_SQL} {fit_facts}",
        "history_kept": f"WITH {_HISTORY_SQL} SELECT * FROM history".replace(folded, own_store),
        "fit_kept_checked": f"WITH {_HISTORY_SQL} {fit_facts}".replace(folded, own_store),
        "evaluate_kept": f"WITH {exact} {_SCORES_SQL.format(condition='')}",
        "predict_given_params": _model_sql(),
        "csv_source": f"WITH {_SALES_SQL} SELECT * FROM sales_rows",
        "csv_taken": f"WITH {_LINES_SQL} SELECT * FROM taken",
        "csv_refused": f"WITH {_LINES_SQL} SELECT * FROM refused_lines",
        "csv_counts": f"""WITH {_LINES_SQL}
SELECT 'taken' AS reason, COUNT(*) AS rows FROM taken HAVING COUNT(*) > 0
UNION ALL
SELECT reason, COUNT(*) FROM refused_lines GROUP BY reason""",
        "forecasts_table_stored": f"""WITH {_FORECAST_SQL}
SELECT ds AS date, store, item, y AS sales, yhat AS sales_predicted,
       yhat_upper AS sales_predicted_upper, yhat_lower AS sales_predicted_lower, training_date
FROM forecast, (VALUES (DATE '{TRAINING_DATE}'), (DATE '{EARLIER_TRAINING}')) v(training_date)""",
        "evaluations_stored": f"WITH {_FORECAST_SQL} {_SCORES_SQL.format(condition='')}",
        "evaluate_from_view": f"WITH {_FORECAST_SQL} {_SCORES_SQL.format(condition='')}",
        "star_loaded": f"WITH {_TWO_FACTS_SQL} {_merge_sql('fact', 'stored_fact')}",
        "star_rejects": _REJECTS_SQL,
        "star_uneven_append": _uneven_facts_sql("COALESCE(first_facts.m, early)"),
        "star_uneven_replace": _uneven_facts_sql("COALESCE(late, first_facts.m)"),
        "star_repeats": f"""WITH {_UNEVEN_SQL}
SELECT store_id, date_id, item_id, n - 1 AS left_out, 'second' AS load
FROM second_facts WHERE n > 1""",
        "months_in_order": f"""WITH {_SALES_SQL}
SELECT {_MONTHS}, ROW_NUMBER() OVER (ORDER BY date_trunc('month', date)) - 1 AS place
FROM sales_rows GROUP BY date_trunc('month', date)""",
        "fact_orphans": f"""WITH {_FACT_SQL}, {_EARLIER_SQL}
SELECT store_id, date_id, item_id, 'date_id' AS reference
FROM fact WHERE date_id NOT IN (SELECT ds FROM earlier)
UNION ALL
SELECT store_id, date_id, item_id, 'store_id'
FROM fact WHERE store_id NOT IN (SELECT id FROM dim_store WHERE store < 5)
UNION ALL
SELECT store_id, date_id, item_id, 'item_id'
FROM fact WHERE item_id NOT IN (SELECT id FROM dim_item WHERE item < 4)""",
    } | _llm_sql()
