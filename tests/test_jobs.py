import datetime
import os

import pytest

from shelfcast.operators import seasonal, star
from shelfcast.operators.baseline import baseline_forecast
from shelfcast.operators.evaluation import evaluate, stamp
from shelfcast.operators.frame import extended_history
from shelfcast.operators.history import clean_history
from shelfcast.plans.forecast_job import run_forecast, stored_forecast
from shelfcast.plans.star_load import (
    _members,
    check_star,
    load_star,
    read_reports,
    read_star,
    reset_star,
)
from shelfcast.schemas import EVALUATION, FACT_KEY, FORECAST_TABLE
from shelfcast.sources.settled import checkpoint_folder
from shelfcast.sources.tables import (
    create_table,
    load_parameters,
    read_partition,
    save_parameters,
    write_evaluations,
    write_forecasts,
)
from tests.conftest import day, plan_of, sales_frame, tuples

FIRST_RUN, SECOND_RUN = day("2017-03-01"), day("2017-04-01")


def sales(spark, series=((1, 1), (10, 50)), days=40, factor=1):
    start = datetime.date(2017, 1, 1)
    return sales_frame(
        spark,
        [
            ((start + datetime.timedelta(n)).isoformat(), store, item, factor * (10 + n % 7))
            for store, item in series
            for n in range(days)
        ],
    )


def baseline(spark, training_date, horizon=5, **kwargs):
    return stamp(baseline_forecast(clean_history(sales(spark, **kwargs)), horizon), training_date)


def test_rerun_replaces_only_its_own_training_date(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    write_forecasts(baseline(spark, FIRST_RUN), path)
    write_forecasts(baseline(spark, SECOND_RUN), path)
    first = tuples(read_partition(spark, path, FORECAST_TABLE, FIRST_RUN))
    write_forecasts(baseline(spark, SECOND_RUN, factor=2), path)
    assert tuples(read_partition(spark, path, FORECAST_TABLE, FIRST_RUN)) == first
    second = read_partition(spark, path, FORECAST_TABLE, SECOND_RUN)
    assert second.count() == len(first) == 2 * 45
    assert second.agg({"sales": "max"}).first()[0] == 32
    assert sorted(second.columns) == sorted(FORECAST_TABLE.fieldNames())
    assert "PartitionFilters: [isnotnull(training_date" in plan_of(second)


def test_forecasts_can_be_stored_as_float(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    write_forecasts(baseline(spark, FIRST_RUN), path, as_float=True)
    assert dict(spark.read.parquet(path).dtypes)["sales_predicted"] == "float"
    stored = read_partition(spark, path, FORECAST_TABLE, FIRST_RUN)
    assert stored.agg({"sales": "max"}).first()[0] == 16.0


def test_catalog_table_over_the_stored_folder(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    write_forecasts(baseline(spark, FIRST_RUN), path)
    create_table(spark, "forecasts_test", path, FORECAST_TABLE)
    create_table(spark, "forecasts_test", path, FORECAST_TABLE)
    found = spark.sql("SELECT count(*), max(training_date) FROM forecasts_test").first()
    assert tuple(found) == (90, FIRST_RUN)
    spark.sql("DROP TABLE forecasts_test")


def test_evaluations_table(spark, tmp_path):
    path = str(tmp_path / "evaluations")
    for run in (FIRST_RUN, SECOND_RUN, SECOND_RUN):
        write_evaluations(evaluate(baseline(spark, run), day("2018-01-01")), path)
    stored = read_partition(spark, path, EVALUATION, SECOND_RUN)
    assert tuples(stored, "store", "item") == [(1, 1), (10, 50)]
    assert spark.read.parquet(path).count() == 4


def test_saved_model_predicts_the_same(spark, tmp_path):
    history = clean_history(sales(spark))
    parameters = seasonal.fit(history)
    save_parameters(parameters, FIRST_RUN, str(tmp_path / "model"))
    loaded = load_parameters(spark, str(tmp_path / "model"), FIRST_RUN)
    assert tuples(loaded) == tuples(parameters)
    frame = extended_history(history)
    assert tuples(seasonal.predict(loaded, frame)) == tuples(seasonal.predict(parameters, frame))


@pytest.fixture
def folder(spark, tmp_path):
    run_forecast(sales(spark), str(tmp_path), FIRST_RUN, day("2017-02-01"))
    return str(tmp_path)


def test_forecast_job_stores_all_results(spark, folder):
    forecast = stored_forecast(spark, folder, FIRST_RUN)
    assert forecast.count() == 2 * (40 + 90)
    scores = read_partition(spark, f"{folder}/evaluations", EVALUATION, FIRST_RUN)
    assert scores.count() == 2
    for score in scores.collect():
        assert 0 <= score.mae <= score.rmse
        assert score.rmse == pytest.approx(score.mse**0.5)
    assert load_parameters(spark, f"{folder}/parameters", FIRST_RUN).count() == 2


def test_star_load_can_be_repeated(spark, folder):
    rows = stored_forecast(spark, folder, FIRST_RUN)
    star_folder = f"{folder}/star"
    reset_star(spark, star_folder)
    assert all(table.count() == 0 for table in read_star(spark, star_folder).values())
    load_star(rows, star_folder)
    loaded = {name: tuples(table) for name, table in read_star(spark, star_folder).items()}
    assert loaded["dim_store"] == [(1, 1), (2, 10)] and loaded["dim_item"] == [(1, 1), (2, 50)]
    assert len(loaded["dim_date"]) == 130 and len(loaded["fact_sales"]) == 260
    for mode in ("append", "replace"):
        load_star(rows, star_folder, mode)
        again = {name: tuples(table) for name, table in read_star(spark, star_folder).items()}
        assert again == loaded


def test_retraining_adds_members_and_refreshes_on_request(spark, tmp_path):
    folder = str(tmp_path)
    reset_star(spark, folder)
    load_star(baseline(spark, FIRST_RUN), folder)
    wider = baseline(spark, SECOND_RUN, series=((1, 1), (10, 50), (7, 1)), days=44, factor=3)
    load_star(wider, folder, "append")
    star = read_star(spark, folder)
    assert tuples(star["dim_store"]) == [(1, 1), (2, 10), (3, 7)]
    fact = star["fact_sales"]
    assert fact.count() == fact.select(*FACT_KEY).distinct().count() == 3 * 49
    assert fact.where("date_id = '2017-02-05' AND store_id = 1").first().sales == 10.0
    load_star(wider, folder, "replace")
    fact = read_star(spark, folder)["fact_sales"]
    assert fact.count() == fact.select(*FACT_KEY).distinct().count() == 3 * 49
    assert fact.where("date_id = '2017-02-05' AND store_id = 1").first().sales == 30.0
    reset_star(spark, folder)
    assert read_star(spark, folder)["fact_sales"].count() == 0
    with pytest.raises(ValueError):
        load_star(wider, folder, "upsert")


def test_replace_keeps_stored_rows_the_batch_lacks(spark, tmp_path):
    folder = str(tmp_path)
    reset_star(spark, folder)
    load_star(baseline(spark, FIRST_RUN), folder)
    load_star(baseline(spark, SECOND_RUN, series=((1, 1),), days=10, factor=2), folder, "replace")
    fact = read_star(spark, folder)["fact_sales"]
    assert fact.count() == 90
    assert fact.where("date_id = '2017-01-01'").agg({"sales": "sum"}).first()[0] == 20 + 10


def test_short_series_are_stored_and_refreshed(spark, tmp_path):
    one_day = sales_frame(spark, [("2017-01-01", 7, 7, 3)])
    folder, report = str(tmp_path), f"{tmp_path}/short_series"
    run_forecast(sales(spark).unionByName(one_day), folder, FIRST_RUN, day("2017-02-01"))
    assert tuples(spark.read.parquet(report), "store", "item", "points") == [(7, 7, 1)]
    assert stored_forecast(spark, folder, FIRST_RUN).where("store = 7").count() == 91
    run_forecast(sales(spark), folder, FIRST_RUN, day("2017-02-01"), series=(1, 1))
    assert spark.read.schema("store int").parquet(report).count() == 1
    run_forecast(sales(spark), folder, FIRST_RUN, day("2017-02-01"))
    assert spark.read.schema("store int").parquet(report).count() == 0


def test_replace_rewrites_only_the_folders_of_the_batch(spark, tmp_path):
    series = tuple((store, 1) for store in range(1, 7))
    history = clean_history(sales(spark, series, days=20))
    rows = baseline_forecast(history)
    reset_star(spark, str(tmp_path))
    load_star(rows, str(tmp_path))
    before = set((tmp_path / "fact_sales").rglob("*.parquet"))
    load_star(rows.where("store = 3"), str(tmp_path), "replace")
    after = set((tmp_path / "fact_sales").rglob("*.parquet"))
    moved = {path.parent.name for path in before ^ after}
    assert moved == {"store_bucket=3"}
    assert read_star(spark, str(tmp_path))["fact_sales"].count() == rows.count()


def test_merge_reads_each_side_once(spark, tmp_path):
    rows = baseline_forecast(clean_history(sales(spark)))
    stores, items = star.dim_store(rows), star.dim_item(rows)
    for name in ("old", "new"):
        star.fact_sales(rows, stores, items).write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    for mode in star.MODES:
        merged = star.merged_facts(old, new, mode)
        assert merged.count() == old.count()
        assert plan_of(merged).count("FileScan") == 2


def test_jobs_leave_no_settled_tables(spark, tmp_path):
    folder = checkpoint_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    run_forecast(sales(spark), str(tmp_path), FIRST_RUN, day("2017-02-01"))
    run_forecast(sales(spark), str(tmp_path), FIRST_RUN, day("2017-02-01"), series=(1, 1))
    reset_star(spark, f"{tmp_path}/star")
    load_star(stored_forecast(spark, str(tmp_path), FIRST_RUN), f"{tmp_path}/star")
    assert set(os.listdir(folder)) <= before


def messy(spark):
    rows = baseline(spark, FIRST_RUN, days=20).drop("training_date")
    bare = rows.limit(3).selectExpr("ds", "int(NULL) AS store", "item", "y", "yhat", "yhat_upper", "yhat_lower")
    return rows.unionByName(rows).unionByName(bare), rows


def test_load_keeps_what_it_cannot_store(spark, tmp_path):
    """Repeats and missing keys in a batch leave a sound star and a report of each load."""
    folder, (batch, rows) = str(tmp_path), messy(spark)
    reset_star(spark, folder)
    assert all(report.count() == 0 for report in read_reports(spark, folder).values())
    for mode in ("append", "replace", "append"):
        load_star(batch, folder, mode, load="batch one")
        assert read_star(spark, folder)["fact_sales"].count() == rows.count()
        assert sum(check_star(spark, folder).values()) == 0
        reports = read_reports(spark, folder)
        assert reports["rejected_facts"].groupBy("reason", "load").count().collect() == [
            ("store is missing", "batch one", 3)
        ]
        assert reports["repeated_facts"].agg({"left_out": "sum"}).first()[0] == rows.count()
    load_star(rows, folder, load="batch two")
    assert read_reports(spark, folder)["rejected_facts"].count() == 3
    load_star(rows, folder, load="batch one")
    assert all(report.count() == 0 for report in read_reports(spark, folder).values())


def test_load_that_may_not_add_members(spark, tmp_path):
    folder, (_, rows) = str(tmp_path), messy(spark)
    reset_star(spark, folder)
    load_star(rows.where("store = 1"), folder)
    load_star(rows, folder, "replace", "second", add_members=False)
    star_now = read_star(spark, folder)
    assert star_now["dim_store"].count() == 1 and sum(check_star(spark, folder).values()) == 0
    reasons = read_reports(spark, folder)["rejected_facts"].select("reason").distinct().collect()
    assert [row[0] for row in reasons] == ["store is unknown, item is unknown"]


def test_members_are_found_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    messy(spark)[0].write.parquet(path)
    plan = plan_of(_members(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<ds:date,store:int,item:int>" in plan
