import datetime

import pytest

from shelfcast.operators import star
from shelfcast.operators.numbering import with_ids
from shelfcast.schemas import DIM_DATE, DIM_STORE, FACT_SALES, FORECAST
from tests.conftest import day, plan_of, tuples


def rows_of(spark, series, days=("2016-02-29", "2016-03-01"), yhat=1.0):
    measures = (5.0, yhat, yhat + 1, yhat - 1)
    rows = [(day(d), store, item, *measures) for store, item in series for d in days]
    return spark.createDataFrame(rows, FORECAST)


def test_ids_follow_key_order_over_the_whole_int_range(spark):
    keys = [-(2**31), -70000, -65536, -1, 0, 1, 65535, 65536, 70000, 2**31 - 1]
    numbered = with_ids(spark.createDataFrame([(k,) for k in keys], "store int"), "store")
    assert tuples(numbered) == list(enumerate(keys, start=1))


def test_ids_match_a_global_row_number(spark):
    keys = spark.range(0, 200_000, 7).selectExpr("int(id * 37 % 1000003) AS item").distinct()
    keys.createOrReplaceTempView("numbering_keys")
    numbered = with_ids(keys, "item")
    expected = spark.sql(
        "SELECT int(row_number() OVER (ORDER BY item)) AS id, item FROM numbering_keys"
    )
    assert numbered.exceptAll(expected).count() == 0
    assert expected.exceptAll(numbered).count() == 0


def test_numbering_reads_its_keys_once(spark, tmp_path):
    spark.range(100).selectExpr("int(id) AS store").write.parquet(str(tmp_path / "keys"))
    numbered = star.dim_store(spark.read.parquet(str(tmp_path / "keys")))
    numbered.collect()
    plan = plan_of(numbered)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


def test_dimensions(spark):
    rows = rows_of(spark, [(10, 50), (3, 7), (3, 50)])
    assert tuples(star.dim_store(rows)) == [(1, 3), (2, 10)]
    assert tuples(star.dim_item(rows)) == [(1, 7), (2, 50)]
    assert star.dim_store(rows).schema.simpleString() == DIM_STORE.simpleString()
    dates = star.dim_date(rows)
    assert dates.schema == DIM_DATE
    assert tuples(dates) == [(day("2016-02-29"), 29, 2, 2016), (day("2016-03-01"), 1, 3, 2016)]


def test_new_members_keep_stored_ids(spark):
    stored = star.dim_store(rows_of(spark, [(4, 1), (9, 1)]))
    later = rows_of(spark, [(9, 1), (7, 1), (2, 1), (4, 1)])
    assert tuples(star.new_stores(stored, later)) == [(3, 2), (4, 7)]
    everyone = stored.unionByName(star.new_stores(stored, later))
    assert star.new_stores(everyone, later).count() == 0
    items = star.dim_item(rows_of(spark, [(1, 8)]))
    assert tuples(star.new_items(items, rows_of(spark, [(1, 8), (1, 6)]))) == [(2, 6)]
    dates = star.dim_date(rows_of(spark, [(1, 1)], ["2017-01-01"]))
    added = star.new_dates(dates, rows_of(spark, [(1, 1)], ["2017-01-01", "2017-01-02"]))
    assert tuples(added, "date") == [(day("2017-01-02"),)]


def test_first_load_into_empty_dimensions(spark):
    empty = spark.createDataFrame([], DIM_STORE)
    assert tuples(star.new_stores(empty, rows_of(spark, [(5, 1), (2, 1)]))) == [(1, 2), (2, 5)]


def test_fact_takes_ids_from_its_own_row(spark):
    rows = rows_of(spark, [(10, 50), (3, 7)], ["2016-02-29"])
    horizon = rows.selectExpr(
        "date_add(ds, 1) AS ds",
        "store",
        "item",
        "double(NULL) AS y",
        "yhat",
        "yhat_upper",
        "yhat_lower",
    )
    fact = star.fact_sales(rows.unionByName(horizon), star.dim_store(rows), star.dim_item(rows))
    assert fact.schema.simpleString() == FACT_SALES.simpleString()
    assert tuples(fact, "store_id", "item_id", "date_id", "sales") == [
        (1, 1, day("2016-02-29"), 5.0),
        (1, 1, day("2016-03-01"), None),
        (2, 2, day("2016-02-29"), 5.0),
        (2, 2, day("2016-03-01"), None),
    ]


def test_look_up_is_the_same_with_and_without_broadcast(spark):
    days = [(datetime.date(2016, 1, 1) + datetime.timedelta(n)).isoformat() for n in range(200)]
    rows = rows_of(spark, [(1, 1), (2, 1)], days).unionByName(rows_of(spark, [(99, 1)], days[:5]))
    stores = star.dim_store(rows).where("store < 99")
    broadcast = tuples(star.look_up_id(rows, stores, "store"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = star.look_up_id(rows, stores, "store")
        assert tuples(shuffled) == broadcast and len(broadcast) == 400
        assert "SortMergeJoin" in plan_of(shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


FACT_ROW = (1, day("2017-01-01"), 1)


def facts(spark, *rows):
    return spark.createDataFrame([(*key, *measures) for key, measures in rows], FACT_SALES)


def test_append_keeps_and_replace_refreshes(spark):
    other, third = (1, day("2017-01-02"), 1), (2, day("2017-01-01"), 1)
    stored = facts(spark, (FACT_ROW, (None, 1.0, 2.0, 0.0)), (third, (9.0, 9.0, 9.0, 9.0)))
    batch = facts(spark, (FACT_ROW, (4.0, 5.0, 6.0, 4.0)), (other, (3.0, 3.0, 4.0, 2.0)))
    appended = {row[:3]: row[3:] for row in tuples(star.merged_facts(stored, batch))}
    assert len(appended) == 3 and appended[FACT_ROW] == (None, 1.0, 2.0, 0.0)
    replaced = {row[:3]: row[3:] for row in tuples(star.merged_facts(stored, batch, "replace"))}
    assert len(replaced) == 3 and replaced[FACT_ROW] == (4.0, 5.0, 6.0, 4.0)
    assert replaced[third] == (9.0, 9.0, 9.0, 9.0)
    with pytest.raises(ValueError):
        star.merged_facts(stored, batch, "upsert")


def test_orphans_name_the_broken_reference(spark):
    rows = rows_of(spark, [(1, 1), (2, 1)])
    dims = star.dim_store(rows), star.dim_item(rows), star.dim_date(rows)
    fact = star.fact_sales(rows, *dims[:2])
    assert star.fact_orphans(fact, *dims).count() == 0
    measures = (1.0, 1.0, 1.0, 1.0)
    broken = fact.unionByName(
        facts(
            spark,
            ((77, day("2016-02-29"), 1), measures),
            ((1, day("1999-01-01"), 88), measures),
        )
    )
    assert tuples(star.fact_orphans(broken, *dims)) == [
        (1, day("1999-01-01"), 88, "date_id"),
        (1, day("1999-01-01"), 88, "item_id"),
        (77, day("2016-02-29"), 1, "store_id"),
    ]


def test_orphans_read_the_fact_once(spark, tmp_path):
    rows = rows_of(spark, [(1, 1), (2, 1)])
    dims = star.dim_store(rows), star.dim_item(rows), star.dim_date(rows)
    star.fact_sales(rows, *dims[:2]).write.parquet(str(tmp_path / "fact"))
    few = [dim.limit(1) for dim in dims]
    orphans = star.fact_orphans(spark.read.parquet(str(tmp_path / "fact")), *few)
    assert {row[3] for row in tuples(orphans)} == {"store_id", "date_id"}
    assert plan_of(orphans).count("FileScan") == 1


def test_repeated_keys(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (None, 1)], "a int, b int")
    assert tuples(star.repeated_keys(rows, "a", "b")) == [(1, 2, 2)]


def uneven(spark):
    """Missing and unknown keys, and a key that three rows have."""
    rows = [
        ("2016-02-29", 1, 7, 5.0, 1.0),
        ("2016-02-29", 1, 7, 4.0, 2.0),
        ("2016-02-29", 1, 7, None, 3.0),
        ("2016-02-29", None, 7, 5.0, 1.0),
        (None, None, None, None, None),
        ("2016-03-01", 1, 99, 5.0, 1.0),
        ("2099-01-01", 88, None, 5.0, 1.0),
        ("2016-03-01", 1, 7, 6.0, 1.0),
    ]
    return spark.createDataFrame(
        [(d and day(d), s, i, y, h, h, h, at) for at, (d, s, i, y, h) in enumerate(rows)],
        "ds date, store int, item int, y double, yhat double, yhat_upper double, "
        "yhat_lower double, line int",
    )


def found_in(spark, rows):
    known = rows_of(spark, [(1, 7)])
    dims = star.dim_store(known), star.dim_item(known), star.dim_date(known)
    return star.identified(rows, *dims)


def test_refused_rows_name_every_fault(spark):
    refused = star.refused(found_in(spark, uneven(spark)))
    assert tuples(refused, "ds", "store", "item", "reason") == [
        (None, None, None, "store is missing, item is missing, date is missing"),
        (day("2016-02-29"), None, 7, "store is missing"),
        (day("2016-03-01"), 1, 99, "item is unknown"),
        (day("2099-01-01"), 88, None, "store is unknown, item is missing, date is unknown"),
    ]


@pytest.mark.parametrize(
    "order, last, taken",
    [(("line",), False, 5.0), (("line",), True, None), ((), False, None), ((), True, 5.0)],
)
def test_one_fact_for_a_key(spark, order, last, taken):
    """By the declared order, else by the measures, where a missing one comes first."""
    facts = star.distinct_facts(found_in(spark, uneven(spark)), order, last)
    assert tuples(facts, "date_id", "sales", "rows") == [
        (day("2016-02-29"), taken, 3),
        (day("2016-03-01"), 6.0, 1),
    ]
    assert tuples(star.repeats(facts)) == [(1, day("2016-02-29"), 1, 2)]


def test_every_row_is_a_fact_or_refused_or_repeated(spark):
    rows = uneven(spark)
    found = found_in(spark, rows)
    facts = star.distinct_facts(found)
    left_out = star.repeats(facts).agg({"left_out": "sum"}).first()[0]
    assert facts.count() + left_out + star.refused(found).count() == rows.count()
    assert star.distinct_facts(found.limit(0)).count() == 0


def test_repeats_are_reduced_before_the_shuffle(spark):
    plan = plan_of(star.distinct_facts(found_in(spark, uneven(spark))))
    assert plan.count("partial_min_by") == 1
