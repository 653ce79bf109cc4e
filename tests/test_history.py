from shelfcast.operators.frame import extended_history, future_frame, recent_days
from shelfcast.operators.history import (
    clean_history,
    colocate,
    daily_history,
    drop_incomplete,
    of_series,
    single_series,
)
from shelfcast.operators.rollups import in_order, sales_by_month, sales_by_year
from tests.conftest import day, nulls_first, plan_of, sales_frame, tuples

ROWS = [
    ("2017-01-01", 1, 1, 10),
    ("2017-01-01", 1, 1, 5),
    ("2017-01-02", 1, 1, None),
    ("2017-01-03", 1, 1, None),
    ("2017-01-03", 1, 1, 4),
    (None, 1, 2, 7),
    ("2017-01-03", 1, None, 3),
    ("2017-01-05", 10, 50, 9),
    ("2017-02-01", 10, 50, 1),
]


def test_daily_history_sums_and_keeps_null_groups(spark):
    history = daily_history(sales_frame(spark, ROWS))
    assert history.schema.simpleString() == "struct<store:int,item:int,ds:date,y:bigint>"
    assert tuples(history) == sorted(
        [
            (1, 1, day("2017-01-01"), 15),
            (1, 1, day("2017-01-02"), None),
            (1, 1, day("2017-01-03"), 4),
            (1, 2, None, 7),
            (1, None, day("2017-01-03"), 3),
            (10, 50, day("2017-01-05"), 9),
            (10, 50, day("2017-02-01"), 1),
        ],
        key=nulls_first,
    )


def test_clean_history_equals_dropping_after_the_sum(spark):
    sales = sales_frame(spark, ROWS)
    clean = tuples(clean_history(sales))
    assert clean == tuples(drop_incomplete(daily_history(sales)))
    assert len(clean) == 4


def test_rollups_keep_the_null_period(spark):
    sales = sales_frame(spark, ROWS)
    assert tuples(sales_by_year(sales)) == sorted([(2017, 32), (None, 7)], key=nulls_first)
    assert tuples(sales_by_month(sales)) == sorted(
        [(day("2017-01-01"), 31), (day("2017-02-01"), 1), (None, 7)], key=nulls_first
    )
    edges = sales_frame(spark, [("2017-01-31", 1, 1, 1), ("2017-02-01", 1, 1, 1)])
    assert in_order(sales_by_month(edges), "month").count() == 2


def test_single_series_is_not_summed(spark):
    rows = single_series(sales_frame(spark, ROWS), 1, 1)
    assert rows.columns == ["ds", "y"] and rows.count() == 5
    summed = daily_history(of_series(sales_frame(spark, ROWS), 10, 50))
    assert [row[3] for row in tuples(summed)] == [9, 1]


def test_frame_adds_the_horizon_and_leaves_gaps(spark):
    days = ["2016-02-27", "2016-02-28", "2016-03-02"]
    history = clean_history(sales_frame(spark, [(d, 2, 3, 1) for d in days]))
    frame = tuples(future_frame(history, 90))
    assert len(frame) == 3 + 90
    assert [row[2] for row in frame[:4]] == [*map(day, days), day("2016-03-03")]
    assert frame[-1][2] == day("2016-05-31")
    assert all(row[:2] == (2, 3) for row in frame)
    filled = extended_history(history, 2)
    assert sorted((row.ds, row.y) for row in filled.collect() if row.y is not None) == [
        (day(d), 1) for d in days
    ]


def test_recent_days_are_counted_per_series(spark):
    history = sales_frame(
        spark,
        [("2015-01-01", 1, 1, 1), ("2017-01-01", 1, 1, 1), ("2015-01-01", 1, 2, 1)],
    ).withColumnRenamed("date", "ds")
    assert tuples(recent_days(history), "ds", "item") == [
        (day("2015-01-01"), 2),
        (day("2017-01-01"), 1),
    ]
    edge = sales_frame(
        spark, [("2017-01-01", 1, 1, 1), ("2017-01-02", 1, 1, 1), ("2018-04-01", 1, 1, 1)]
    ).withColumnRenamed("date", "ds")
    assert tuples(recent_days(edge), "ds") == [(day("2017-01-02"),), (day("2018-04-01"),)]


def test_series_filter_and_null_checks_reach_a_stored_table(spark, tmp_path):
    sales_frame(spark, ROWS).write.parquet(str(tmp_path / "sales"))
    stored = spark.read.parquet(str(tmp_path / "sales"))
    plan = plan_of(daily_history(of_series(stored, 1, 1)))
    assert "EqualTo(store,1)" in plan and "EqualTo(item,1)" in plan
    plan = plan_of(clean_history(stored))
    for column in ("date", "store", "item", "sales"):
        assert f"IsNotNull({column})" in plan


def test_history_is_summed_before_its_shuffle(spark):
    plan = plan_of(daily_history(sales_frame(spark, ROWS)))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_colocate_adds_one_exchange_that_later_steps_share(spark):
    history = clean_history(sales_frame(spark, ROWS))
    together = colocate(history, 5)
    assert together.rdd.getNumPartitions() == 5
    assert plan_of(together).count("Exchange hashpartitioning(store") == 2
    # The series window needs no exchange of its own.
    assert plan_of(extended_history(together)).count("Exchange hashpartitioning(store") == 2
    places = together.selectExpr("store", "item", "spark_partition_id() AS p").distinct()
    assert places.count() == places.select("store", "item").distinct().count()


def test_cached_history_gives_the_same_rows(spark):
    history = clean_history(sales_frame(spark, ROWS))
    expected = tuples(history)
    history.persist()
    assert tuples(history) == expected and history.is_cached
    history.unpersist()
    assert not history.is_cached
