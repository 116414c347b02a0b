"""Hot keys: thresholds at any size, and parts of about an even share."""

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import skew
from weftgraph.operators.runtime import ROWS_PER_PARTITION


@pytest.mark.parametrize("rows", [10**6, 10**9, 10**11, 10**12, 5 * 10**12])
def test_no_key_of_more_than_two_even_shares_stays_whole(rows):
    partitions = max(1, -(-rows // ROWS_PER_PARTITION))
    limit = skew.hot_threshold(rows, partitions)
    assert limit <= max(skew.HOT_ROWS, 2 * ROWS_PER_PARTITION)
    # Hot keys of just over the limit are most in number, and one key with all rows has the most parts.
    assert rows // (limit + 1) <= partitions / 2 or partitions == 1
    assert -(-rows // (limit // 2)) <= partitions + 2


@pytest.fixture
def hub(spark, monkeypatch):
    """8,000 rows of 1,200 keys, half of them one key's, most of those with one value, over 8 partitions."""
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    key = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1200).cast("long")
    value = F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(-1)).cast("long")
    rows = spark.range(0, 8000, 1, 8).select(key.alias("key"), value.alias("value"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return rows, skew.hot_keys(counts, "key", "n", skew.hot_threshold(8000, 16))


def test_rows_of_a_hot_key_are_split_evenly(hub):
    rows, hot = hub
    assert [tuple(r) for r in hot.collect()] == [(7, 9)]
    parts = [r[1] for r in skew.dealt(rows, "key", hot).groupBy("_salt").count().collect()]
    assert len(parts) == 8 or len(parts) == 9
    assert sum(parts) == rows.filter("key = 7").count() and max(parts) <= 3 * sum(parts) / 9
    again = skew.dealt(rows, "key", hot)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, again.collect()))


def test_a_split_join_gives_what_a_plain_one_does(spark, hub):
    rows, hot = hub
    table = spark.range(0, 1000).select(F.col("id").alias("key"), F.array("id", F.col("id") * 2).alias("list"))
    found = skew.keyed_join(rows, table, "key", hot)
    plain = rows.join(table, "key")
    assert found.columns == plain.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
