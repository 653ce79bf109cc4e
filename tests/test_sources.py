import pytest

from shelfcast.schemas import SALES
from shelfcast.sources import views
from shelfcast.sources.sales import read_sales_csv, sales_from_lineitem
from shelfcast.sources.settled import SETTING, checkpoint_folder, settle
from tests.conftest import day, nulls_first, plan_of, sales_frame, tuples


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        "date,store,item,sales\n"
        "2017-01-01,1,1,13\n"
        "bad,1,2,7\n"
        "2017-01-03,1,x,3\n"
        "2017-01-04,10,50,\n"
    )
    return str(path)


def test_csv_keeps_rows_with_bad_fields(spark, csv):
    sales = read_sales_csv(spark, csv)
    assert sales.schema == SALES
    assert tuples(sales) == sorted(
        [
            (day("2017-01-01"), 1, 1, 13),
            (None, 1, 2, 7),
            (day("2017-01-03"), 1, None, 3),
            (day("2017-01-04"), 10, 50, None),
        ],
        key=nulls_first,
    )


def test_lineitem_mapping_uses_every_line(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sales = sales_from_lineitem(lineitem)
    assert sales.schema == SALES
    assert sales.count() == lineitem.count()
    assert sales.select("store").distinct().count() == 5
    assert sales.select("item").distinct().count() == 4
    wide = sales_from_lineitem(lineitem, stores=None, items=None)
    assert (
        wide.select("store").distinct().count() == lineitem.select("l_suppkey").distinct().count()
    )


def test_lineitem_scan_reads_four_columns(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(sales_from_lineitem(lineitem))
    schema = plan.split("ReadSchema: ")[1]
    assert schema.count(":") == 4 and "l_comment" not in schema


def test_views_and_bound_parameters(spark):
    rows = [("2016-02-29", 1, 1, 2), ("2017-01-31", 1, 1, 3), ("2017-02-01", 10, 50, 4)]
    view = views.register(sales_frame(spark, rows), "view_test")
    assert views.read_view(spark, view).count() == 3
    years = views.run_sql(spark, views.YEAR_SALES, sales=view).collect()
    assert [tuple(row) for row in years] == [(2016, 2), (2017, 7)]
    months = views.run_sql(spark, views.MONTH_SALES, sales=view).collect()
    assert [row.month.isoformat() for row in months] == ["2016-02-01", "2017-01-01", "2017-02-01"]
    one = views.run_sql(spark, views.SERIES_SALES, sales=view, store=10, item=50)
    assert tuples(one) == [(day("2017-02-01"), 4)]


def test_settled_rows_are_stored_where_the_session_says(spark):
    settled = settle(spark.range(5).selectExpr("id", "id * 2 AS twice"))
    assert tuples(settled) == [(i, 2 * i) for i in range(5)]
    named = spark.conf.get(SETTING, None)
    folder = checkpoint_folder(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir())
    assert folder.removeprefix("file:") in settled.inputFiles()[0]
