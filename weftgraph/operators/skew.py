"""Hot keys: how many there can be, and joins that do not gather them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

# A key with fewer rows than this is never worth splitting.
HOT_ROWS = 1_000_000

SALT, SALTS = "_salt", "_salts"


def hot_threshold(rows: int, partitions: int) -> int:
    """A key is hot above this many of ``rows``: twice an even share, so at most half as many as partitions are."""
    return max(HOT_ROWS, 2 * rows // partitions)


def hot_keys(counts: DataFrame, key: str, rows: str, limit: int) -> DataFrame:
    """``(key, _salts)``: the keys of ``counts(key, rows)`` above ``limit`` and the parts that their rows are split into.

    A part has about an even share, so all parts together are at most one and a half times as many as partitions.
    The two numbers of each hot key are all that is broadcast of them: 16 bytes for 32 million rows of the table or more.
    """
    share = max(1, limit // 2)
    return counts.where(F.col(rows) > limit).select(key, F.ceil(F.col(rows) / share).cast("long").alias(SALTS))


def dealt(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The rows of hot keys, each with the ``_salt`` of its part.

    A salt follows from the row's values and the partition it comes from, so a task that is run again deals as
    before, and equal rows are split too.
    """
    names = [f.name for f in rows.schema.fields if not isinstance(f.dataType, ArrayType)]
    salt = F.pmod(F.xxhash64(*names) + F.spark_partition_id(), F.col(SALTS))
    return rows.join(F.broadcast(hot), key).withColumn(SALT, salt).drop(SALTS)


def repeated(table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The row of each hot key in ``table``, once for each part, with the part's ``_salt``."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(SALTS) - 1))
    return table.join(F.broadcast(hot), key).withColumn(SALT, every).drop(SALTS)


def keyed_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """``rows`` joined to ``table`` on ``key``, where ``hot`` are the keys too frequent in ``rows``, as ``hot_keys`` gives them.

    ``table`` has one row per key. Rows of hot keys are dealt to parts, and each part meets a copy of its key's
    row; all others meet on the key alone.
    """
    if hot is None:
        return rows.join(table, key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table, key)
    return cold.unionByName(split_join(rows, table, key, hot))


def split_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The part of ``keyed_join`` for hot keys. Both sides are dealt by part as well, however they or the session's joins are partitioned."""
    parts = repeated(table, key, hot).repartition(key, SALT)
    return dealt(rows, key, hot).repartition(key, SALT).join(parts, [key, SALT]).drop(SALT)
