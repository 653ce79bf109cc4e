import pytest

import submit
from shelfcast.plans.forecast_job import stored_forecast
from shelfcast.plans.star_load import read_star
from shelfcast.sources.intake import read_intake
from tests.conftest import day, tuples


@pytest.fixture
def csv(tmp_path):
    lines = ["date,store,item,sales"]
    lines += [f"2017-01-{d:02d},{s},50,{d % 7 + s}" for s in (1, 10) for d in range(1, 32)]
    path = tmp_path / "train.csv"
    path.write_text("\n".join([*lines, "bad,1,50,3"]) + "\n")
    return str(path)


def test_all_commands(spark, csv, tmp_path, capsys):
    folder = str(tmp_path / "out")
    submit.main(["rollups", "--sales", csv, "--folder", folder])
    years = tuples(spark.read.parquet(f"{folder}/sales_by_year"), "year")
    assert years == [(None,), (2017,)]
    submit.main(
        ["forecast", "--sales", csv, "--folder", folder, "--training-date", "2017-02-01"]
        + ["--table", "all_forecasts"]
    )
    assert spark.table("all_forecasts").where("training_date = '2017-02-01'").count() == 2 * 121
    spark.sql("DROP TABLE all_forecasts")
    said = capsys.readouterr().out
    assert "date is unreadable: 1" in said and "taken: 62" in said
    refused = read_intake(spark, f"{folder}/intake").refused
    assert tuples(refused, "line") == [("bad,1,50,3",)]
    assert stored_forecast(spark, folder, day("2017-02-01")).count() == 2 * (31 + 90)
    submit.main(["reset-star", "--folder", folder])
    for _ in range(2):
        submit.main(["load-star", "--folder", folder, "--training-date", "2017-02-01"])
    submit.main(["check-star", "--folder", folder])
    assert "rejected_facts: 0" in capsys.readouterr().out
    submit.main(["predict", "--folder", folder, "--training-date", "2017-02-01"])
    predicted = spark.read.parquet(f"{folder}/predictions")
    columns = ["date", "store", "item", "sales", "sales_predicted"]
    assert tuples(predicted, *columns) == tuples(spark.read.parquet(f"{folder}/forecasts"), *columns)
    star = read_star(spark, f"{folder}/star")
    assert tuples(star["dim_store"]) == [(1, 1), (2, 10)]
    assert star["fact_sales"].count() == 2 * (31 + 90)


def test_one_series(spark, csv, tmp_path):
    folder = str(tmp_path / "out")
    command = ["forecast", "--sales", csv, "--folder", folder, "--training-date", "2017-02-01"]
    submit.main([*command, "--store", "10", "--item", "50", "--horizon", "7"])
    rows = stored_forecast(spark, folder, day("2017-02-01"))
    assert tuples(rows.select("store", "item").distinct()) == [(10, 50)]
    assert rows.count() == 31 + 7
    with pytest.raises(SystemExit):
        submit.main([*command, "--store", "10"])
    with pytest.raises(SystemExit):
        submit.main([*command, "--horizon", "-1"])


def test_one_series_leaves_the_others_alone(spark, csv, tmp_path, capsys):
    folder = str(tmp_path / "out")
    command = ["forecast", "--sales", csv, "--folder", folder, "--training-date", "2017-02-01"]
    submit.main(command)
    names = ("forecasts", "parameters", "evaluations")
    before = {name: tuples(spark.read.parquet(f"{folder}/{name}")) for name in names}
    submit.main([*command, "--store", "10", "--item", "50"])
    after = {name: tuples(spark.read.parquet(f"{folder}/{name}")) for name in names}
    assert after == before
    assert "rmse" in capsys.readouterr().out
    submit.main([*command, "--store", "10", "--item", "50", "--horizon", "7"])
    rows = stored_forecast(spark, folder, day("2017-02-01"))
    assert rows.where("store = 1").count() == 31 + 90
    assert rows.where("store = 10").count() == 31 + 7


def test_forecast_of_the_grown_history(spark, csv, tmp_path):
    folder = str(tmp_path / "out")
    forecast = ["forecast", "--folder", folder, "--training-date", "2017-02-01", "--horizon", "3"]
    with pytest.raises(SystemExit):
        submit.main(forecast)
    for _ in range(2):
        submit.main(["grow", "--sales", csv, "--folder", folder])
    submit.main(forecast)
    grown = tuples(stored_forecast(spark, folder, day("2017-02-01")))
    submit.main([*forecast, "--sales", csv])
    assert tuples(stored_forecast(spark, folder, day("2017-02-01"))) == grown
