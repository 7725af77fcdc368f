"""Attaching a per-key value to every row when one key may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# At most this many keys can hold more than total / MAX_HOT_KEYS rows each, so the
# broadcast table below never has more rows than this, whatever the data size.
MAX_HOT_KEYS = 20_000

# Groups up to this size are not worth splitting, unless the table is small.
MIN_HOT_ROWS = 10_000


def hot_threshold(total_rows: int, max_hot_keys: int = MAX_HOT_KEYS, min_rows: int = MIN_HOT_ROWS) -> int:
    """Row count above which a key counts as hot. Fewer than ``max_hot_keys`` keys exceed it.

    In a small table that is a quarter of an even partition, so that no task gets much more
    than its share.
    """
    spark = SparkSession.getActiveSession()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions")) if spark else 1
    return max(1, -(-total_rows // max_hot_keys), min(min_rows, total_rows // (4 * partitions)))


def attach_group_value(rows: DataFrame, groups: DataFrame, keys: list[str], value: str, size: str, hot_rows: int) -> DataFrame:
    """Join ``groups`` (unique ``keys``, with ``value`` and ``size``) to ``rows``; rows without a group go.

    Groups above ``hot_rows`` rows reach their rows by broadcast, and those rows leave before
    the shuffle, where they lie. All others join on their keys, so no task gets more than
    ``hot_rows`` rows of a key. ``value`` must not be null in ``groups``; keys must not be null.
    ``rows`` is read twice: materialise it where it is dear.
    """
    hot = groups.where(F.col(size) > hot_rows).select(*keys, F.col(value).alias(value))
    cold = groups.where(F.col(size) <= hot_rows).select(*keys, F.col(value).alias(value))
    hot_keys = hot.select(*keys, F.lit(True).alias("_hot"))
    spread = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot_keys), keys, "left").where(F.col("_hot").isNull()).drop("_hot")
    return spread.unionByName(rest.join(cold, keys))
