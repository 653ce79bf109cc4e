"""Column contracts of the frames and tables.

Fixed values: column names and their order are what users of the tables rely on.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_INT, _LONG, _DOUBLE, _DATE = IntegerType(), LongType(), DoubleType(), DateType()
_DOUBLES = ArrayType(_DOUBLE)

SERIES = ("store", "item")

SALES = _schema(date=_DATE, store=_INT, item=_INT, sales=_INT)

HISTORY = _schema(store=_INT, item=_INT, ds=_DATE, y=_LONG)

FORECAST = _schema(
    ds=_DATE, store=_INT, item=_INT, y=_DOUBLE, yhat=_DOUBLE, yhat_upper=_DOUBLE, yhat_lower=_DOUBLE
)

FORECAST_TABLE = _schema(
    date=_DATE,
    store=_INT,
    item=_INT,
    sales=_DOUBLE,
    sales_predicted=_DOUBLE,
    sales_predicted_upper=_DOUBLE,
    sales_predicted_lower=_DOUBLE,
    training_date=_DATE,
)

EVALUATION = _schema(
    training_date=_DATE, store=_INT, item=_INT, mae=_DOUBLE, mse=_DOUBLE, rmse=_DOUBLE
)

# One row per fitted series. ``changepoints`` are on the scaled time axis that runs
# from 0 on ``first_ds`` to 1 on ``last_ds``; ``deltas`` has the same length.
PARAMETERS = _schema(
    store=_INT,
    item=_INT,
    first_ds=_DATE,
    last_ds=_DATE,
    points=_INT,
    scale=_DOUBLE,
    slope=_DOUBLE,
    level=_DOUBLE,
    changepoints=_DOUBLES,
    deltas=_DOUBLES,
    season=_DOUBLES,
    sigma=_DOUBLE,
    converged=BooleanType(),
    rounds=_INT,
)

# Series seen on one day, which get a flat forecast.
SHORT_SERIES = _schema(store=_INT, item=_INT, points=_INT, reason=StringType())

DIM_STORE = _schema(id=_INT, store=_INT)
DIM_ITEM = _schema(id=_INT, item=_INT)
DIM_DATE = _schema(date=_DATE, day=_INT, month=_INT, year=_INT)

FACT_KEY = ("store_id", "date_id", "item_id")
FACT_SALES = _schema(
    store_id=_INT,
    date_id=_DATE,
    item_id=_INT,
    sales=_DOUBLE,
    sales_predicted=_DOUBLE,
    sales_predicted_upper=_DOUBLE,
    sales_predicted_lower=_DOUBLE,
)

# What a load did not take: forecast rows that cannot be facts, and keys that came again.
REJECTED_FACTS = StructType([*FORECAST, StructField("reason", StringType())])
REPEATED_FACTS = _schema(store_id=_INT, date_id=_DATE, item_id=_INT, left_out=_LONG)

# Lines of sales files that cannot be used, with what could be read of them, and how many.
REFUSED_LINES = StructType(
    [*SALES, StructField("line", StringType()), StructField("reason", StringType())]
)
INTAKE_COUNTS = _schema(reason=StringType(), rows=_LONG)

# Files that a grown history holds with the months of their sales, and the run of each month.
HISTORY_FILES = _schema(
    file=StringType(), length=_LONG, modified=TimestampType(), months=ArrayType(StringType())
)
HISTORY_MONTHS = _schema(month=StringType(), run=StringType())
