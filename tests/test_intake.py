import datetime

import pytest

from shelfcast.operators.history import clean_history
from shelfcast.sources.intake import judged_sales_csv, read_intake, take_in
from shelfcast.sources.sales import read_sales_csv
from tests.conftest import plan_of, tuples

HEADER = "date,store,item,sales"
FIRST = datetime.date(2017, 1, 1)


@pytest.fixture
def write(tmp_path):
    def lines(*rows, name="a.csv", header=True):
        folder = tmp_path / "sales"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join([HEADER] * header + list(rows)) + "\n")
        return str(folder)

    return lines


@pytest.mark.parametrize(
    "line, read, reason",
    [
        ("2017-01-01,1,2,3", (FIRST, 1, 2, 3), None),
        ('"2017-01-01","1","2","3"', (FIRST, 1, 2, 3), None),
        ("2017-01-01,1,2,-3", (FIRST, 1, 2, -3), None),
        ("01.01.2017,1,2,3", (None, 1, 2, 3), "date is unreadable"),
        ("2017-13-45,1,2,3", (None, 1, 2, 3), "date is unreadable"),
        ("2017-01-01,x,2,3", (FIRST, None, 2, 3), "store is unreadable"),
        ("2017-01-01,1,99999999999,3", (FIRST, 1, None, 3), "item is unreadable"),
        ("2017-01-01,1,2,3.5", (FIRST, 1, 2, None), "sales is unreadable"),
        ("2017-01-01,x,y,z", (FIRST, None, None, None), "store is unreadable"),
        ("2017-01-01,1,2", (FIRST, 1, 2, None), "wrong number of fields"),
        ("2017-01-01,1,2,3,4", (FIRST, 1, 2, 3), "wrong number of fields"),
        ("2017-01-01", (FIRST, None, None, None), "wrong number of fields"),
        (",1,2,3", (None, 1, 2, 3), "date is missing"),
        ("2017-01-01,,2,3", (FIRST, None, 2, 3), "store is missing"),
        ("2017-01-01,1,2,", (FIRST, 1, 2, None), "sales is missing"),
        (",,,", (None, None, None, None), "date is missing"),
        (HEADER, (None, None, None, None), "date is unreadable"),
    ],
)
def test_first_fault_of_a_line(spark, write, line, read, reason):
    (row,) = judged_sales_csv(spark, write(line)).collect()
    assert (*read, reason) == (*row[:4], row["reason"])
    assert row["line"] == (None if reason is None else line)


def test_readable_rows_are_those_of_the_plain_source(spark, write):
    path = write("2017-01-01,1,2,3", "bad,1,2,7", "2017-01-02,1,2,4", "", "2017-01-03,1,x,3")
    write("2017-02-01,3,3,3", "2017-02-01,3,3", name="b.csv")
    intake = take_in(spark, path, path + "-taken")
    assert tuples(clean_history(intake.sales)) == tuples(clean_history(read_sales_csv(spark, path)))
    assert tuples(intake.refused, "line", "reason") == [
        ("2017-01-03,1,x,3", "item is unreadable"),
        ("2017-02-01,3,3", "wrong number of fields"),
        ("bad,1,2,7", "date is unreadable"),
    ]
    assert tuples(intake.counts) == [
        ("date is unreadable", 1),
        ("item is unreadable", 1),
        ("taken", 3),
        ("wrong number of fields", 1),
    ]


def test_intake_is_stored_and_replaced(spark, write):
    path = write("2017-01-01,1,2,3", "bad,1,2,7")
    take_in(spark, path, path + "-taken")
    stored = read_intake(spark, path + "-taken")
    assert stored.sales.count() == 1 and stored.refused.count() == 1
    assert "PartitionFilters: [isnotnull(refused" in plan_of(stored.sales)
    path = write("2017-01-01,1,2,3", "2017-01-01,1,2,4")
    take_in(spark, path, path + "-taken")
    assert stored.sales.sparkSession is spark
    again = read_intake(spark, path + "-taken")
    assert again.sales.count() == 2 and again.refused.count() == 0
    assert tuples(again.counts) == [("taken", 2)]


def test_every_line_is_counted_once(spark, write):
    for at in range(6):
        path = write(*["2017-01-01,1,2,3", "x,1,2,3", "2017-01-01,1"] * 50, name=f"{at}.csv")
    intake = take_in(spark, path, path + "-taken")
    assert sum(rows for _, rows in tuples(intake.counts)) == 900
    assert intake.sales.count() == 300 and intake.refused.count() == 600


def test_files_without_rows(spark, write):
    intake = take_in(spark, write(), write() + "-taken")
    assert intake.sales.count() == intake.refused.count() == intake.counts.count() == 0


def test_no_header(spark, write):
    path = write("2017-01-01,1,2,3", "2017-01-02,1,2,3", header=False)
    assert take_in(spark, path, path + "-taken", header=False).sales.count() == 2
