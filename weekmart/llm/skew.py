"""Joins back to a table of counted keys, some of which hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekmart.session import staged

HOT_ROWS, HOT_KEYS = 1000, 4096


def join_by_size(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row a key and names in ``size`` how many rows hold the key.

    The HOT_KEYS largest keys of over HOT_ROWS rows meet their rows by broadcast, the rest by shuffle. So a key that is
    shuffled has at most HOT_ROWS rows, or one in HOT_KEYS of all. Rows with a null key are left out; both sides are read
    twice if there is a hot key and should be staged.
    """
    hot = staged(table.where(F.col(size) > HOT_ROWS).orderBy(F.desc(size), key).limit(HOT_KEYS), "hot-keys")
    if hot.isEmpty():
        return rows.join(table, key)
    hot = F.broadcast(hot)
    rest = rows.join(hot.select(key), key, "left_anti").join(table, key)
    return rows.join(hot, key).unionByName(rest)
