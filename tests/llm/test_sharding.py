import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from shelfcast.llm import sharding
from shelfcast.llm.text import DOCUMENTS


def check(docs, out, shards=8, slack=None):
    """Every row once, slots without gaps, sizes right and nearly equal."""
    rows = out.collect()
    assert len(rows) == docs.count()
    slots, sizes = {}, [0] * shards
    for row in rows:
        size = len((row["text"] or "").encode()) + 1
        assert row["size"] == size
        slots.setdefault(row["shard"], []).append(row["slot"])
        sizes[row["shard"]] += size
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))
    largest = max((row["size"] for row in rows), default=0)
    allowed = (largest if slack is None else slack) + 2 * sharding.SHARD_TOLERANCE * sum(sizes) / shards
    assert max(sizes) - sum(sizes) / shards <= allowed
    assert sum(sizes) / shards - min(sizes) <= allowed
    return rows


def test_documents(documents):
    rows = check(documents, sharding.shard(documents))
    places = {}
    for row in rows:
        places.setdefault(row["text"], set()).add(row["shard"])
    assert sum(len(p) > 1 for p in places.values()) <= 7


@pytest.mark.parametrize("parts", [1, 5])
def test_parts_change_no_shard_size(documents, parts):
    check(documents, sharding.shard(documents, parts=parts))


def test_order_of_slots_is_key_order(documents):
    keyed = sharding.keyed(sharding.shard(documents).drop("size"))
    rows = keyed.select("shard", "slot", sharding.TEXT_KEY, sharding.ROW_KEY).collect()
    in_place = sorted(rows, key=lambda row: (row["shard"], row["slot"]))
    keys = [(row[2], row[3]) for row in in_place]
    assert keys == sorted(keys)


def test_group_of_copies_larger_than_a_shard_is_divided(spark):
    rows = [(at, "the same text", "en", "s", 0) for at in range(3000)]
    rows += [(at, f"text {at}", "en", "s", 0) for at in range(3000, 6000)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    check(docs, sharding.shard(docs))


def test_odd_rows(odd_docs, no_docs):
    rows = check(odd_docs, sharding.shard(odd_docs), slack=10**6)
    assert isinstance(rows[0], Row)
    assert sharding.shard(no_docs).count() == 0
    clash = odd_docs.withColumn("shard", F.lit("mine")).withColumn("_part", F.lit(3))
    assert sharding.shard(clash).count() == odd_docs.count()


def test_reruns_and_partitions_agree(documents):
    a = sharding.shard(documents, parts=3).select("doc_id", "shard", "slot").collect()
    b = sharding.shard(documents.repartition(5), parts=3).select("doc_id", "shard", "slot").collect()
    assert sorted(a) == sorted(b)


def test_written_shards(documents, spark, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count() and back.select("shard").distinct().count() == 4


def test_texts_move_once(documents):
    plan = sharding.shard(documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
