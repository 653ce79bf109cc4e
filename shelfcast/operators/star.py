"""Star schema: store, item and date dimensions around a sales fact.

Rows are forecast rows: ``ds, store, item, y, yhat, yhat_upper, yhat_lower``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.numbering import with_ids
from shelfcast.schemas import DIM_DATE, FACT_KEY, FACT_SALES, FORECAST, REPEATED_FACTS

MODES = ("append", "replace")


def _known(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def dim_store(rows: DataFrame) -> DataFrame:
    """``id, store`` for every store, numbered from 1 in store order."""
    return with_ids(_known(rows, "store"), "store")


def dim_item(rows: DataFrame) -> DataFrame:
    """``id, item`` for every item, numbered from 1 in item order."""
    return with_ids(_known(rows, "item"), "item")


def dim_date(rows: DataFrame, column: str = "ds") -> DataFrame:
    """``date, day, month, year`` for every date, horizon included."""
    return _known(rows, column).select(
        F.col(column).alias("date"),
        F.dayofmonth(column).alias("day"),
        F.month(column).alias("month"),
        F.year(column).alias("year"),
    ).to(DIM_DATE)


def _missing(stored: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return _known(rows, key).join(stored.select(key), key, "left_anti")


def new_stores(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Dimension rows for stores not yet in ``stored``; ids follow its largest id."""
    return with_ids(_missing(stored, rows, "store"), "store", stored)


def new_items(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Dimension rows for items not yet in ``stored``; ids follow its largest id."""
    return with_ids(_missing(stored, rows, "item"), "item", stored)


def new_dates(stored: DataFrame, rows: DataFrame, column: str = "ds") -> DataFrame:
    """Dimension rows for dates not yet in ``stored``."""
    return dim_date(rows, column).join(stored.select("date"), "date", "left_anti")


def look_up_id(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Attach ``<key>_id`` from a dimension ``id, key``; rows with an unknown key drop out.

    A plain equi join: Spark knows the size of a stored dimension and broadcasts it if it is
    small, and otherwise splits a store that holds a large share of the rows at run time.
    """
    ids = dimension.select(key, F.col("id").alias(f"{key}_id"))
    return rows.join(ids, key)


def fact_sales(rows: DataFrame, stores: DataFrame, items: DataFrame) -> DataFrame:
    """Fact rows with the surrogate ids of each row's own store and item."""
    identified = look_up_id(look_up_id(rows, stores, "store"), items, "item")
    return identified.select(
        "store_id",
        F.col("ds").alias("date_id"),
        "item_id",
        F.col("y").alias("sales"),
        F.col("yhat").alias("sales_predicted"),
        F.col("yhat_upper").alias("sales_predicted_upper"),
        F.col("yhat_lower").alias("sales_predicted_lower"),
    ).to(FACT_SALES)


def identified(
    rows: DataFrame, stores: DataFrame, items: DataFrame, dates: DataFrame
) -> DataFrame:
    """Rows with ``store_id, item_id, date_id`` and ``reason``, NULL for a row that can be a fact.

    No row is lost: one with a missing key, or with a key that its dimension does not hold,
    says so in ``reason``, and names every such key. The dimensions are joined from the left
    side, so a missing key that many rows share is split at run time like any hot key.
    """
    sides = (
        ("store", "store_id", stores.select("store", F.col("id").alias("store_id"))),
        ("item", "item_id", items.select("item", F.col("id").alias("item_id"))),
        ("ds", "date_id", dates.select(F.col("date").alias("ds"), F.col("date").alias("date_id"))),
    )
    faults = []
    for key, found, members in sides:
        name = found.removesuffix("_id")
        rows = rows.join(members, key, "left")
        faults.append(F.when(F.col(key).isNull(), F.lit(f"{name} is missing")))
        unknown = F.col(key).isNotNull() & F.col(found).isNull()
        faults.append(F.when(unknown, F.lit(f"{name} is unknown")))
    reason = F.array_join(F.array_compact(F.array(*faults)), ", ")
    return rows.withColumn("reason", F.when(reason != "", reason))


def refused(rows: DataFrame) -> DataFrame:
    """Forecast rows of ``identified`` that cannot be facts, with their ``reason``."""
    return rows.where("reason IS NOT NULL").select(*FORECAST.names, "reason")


def _place(order: tuple[str, ...]) -> Column:
    """Where a row stands in the declared order; rows that tie there go by their measures."""
    measures = [name for name in FORECAST.names if name not in ("ds", "store", "item")]
    return F.struct(*[F.col(name) for name in order], *[F.col(name) for name in measures])


def distinct_facts(rows: DataFrame, order: tuple[str, ...] = (), last: bool = False) -> DataFrame:
    """``identified`` rows as facts, one for a key: the first of ``order``, or the last.

    ``rows`` is the number of rows that had the key. Each task reduces its own rows of a key
    before the shuffle, so a key that holds a large share of a batch moves once for a task.
    """
    measures = F.struct(
        F.col("y").alias("sales"),
        F.col("yhat").alias("sales_predicted"),
        F.col("yhat_upper").alias("sales_predicted_upper"),
        F.col("yhat_lower").alias("sales_predicted_lower"),
    )
    pick = F.max_by if last else F.min_by
    one = rows.where("reason IS NULL").groupBy(*FACT_KEY)
    taken = one.agg(pick(measures, _place(order)).alias("m"), F.count(F.lit(1)).alias("rows"))
    return taken.select(*FACT_KEY, "m.*", "rows")


def repeats(facts: DataFrame) -> DataFrame:
    """Keys of ``distinct_facts`` that more than one row had, with the number of rows left out."""
    left_out = (F.col("rows") - 1).alias("left_out")
    return facts.where("rows > 1").select(*FACT_KEY, left_out).to(REPEATED_FACTS)


def new_facts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch whose key is not stored yet: the first write of a key wins."""
    return batch.join(stored.select(*FACT_KEY), list(FACT_KEY), "left_anti").select(batch.columns)


def merged_facts(stored: DataFrame, batch: DataFrame, mode: str = "append") -> DataFrame:
    """The fact after a load.

    Keys are unique within ``stored`` and within ``batch``, as they are for the rows of
    one forecast. ``append`` keeps stored rows and adds rows with new keys. ``replace``
    lets the batch win, so that a retrained model refreshes its predictions. One join reads
    each side once.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    measures = [name for name in stored.columns if name not in FACT_KEY]
    sides = [
        facts.select(*FACT_KEY, F.struct(*measures).alias(name))
        for name, facts in (("old", stored), ("new", batch))
    ]
    order = ("old", "new") if mode == "append" else ("new", "old")
    both = sides[0].join(sides[1], list(FACT_KEY), "full")
    merged = both.select(*FACT_KEY, F.coalesce(*order).alias("row")).select(*FACT_KEY, "row.*")
    return merged.select(*stored.columns)


def fact_orphans(
    fact: DataFrame, stores: DataFrame, items: DataFrame, dates: DataFrame
) -> DataFrame:
    """Fact keys that point at no dimension row, once per failed ``reference``.

    The fact is read once: each dimension marks the keys that it knows, and the names of
    the marks that are missing are unrolled. A NULL key points at nothing.
    """
    checks = (("store_id", stores, "id"), ("item_id", items, "id"), ("date_id", dates, "date"))
    keys = fact.select(*FACT_KEY)
    for column, dimension, member in checks:
        known = dimension.select(F.col(member).alias(column), F.lit(True).alias(f"known_{column}"))
        keys = keys.join(known, column, "left")
    failed = [F.when(F.col(f"known_{column}").isNull(), F.lit(column)) for column, _, _ in checks]
    return keys.select(*FACT_KEY, F.explode(F.array_compact(F.array(*failed))).alias("reference"))


def repeated_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that stand in more than one row, with their number of rows."""
    return rows.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")
