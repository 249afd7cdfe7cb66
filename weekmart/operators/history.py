"""History merge: which rows survive when weeks are delivered again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.operators.series import latest_weeks
from weekmart.session import staged


def week_keys(df: DataFrame, week: str = WEEK) -> DataFrame:
    """The distinct weeks as ``_week``, null among them."""
    return df.select(F.col(week).alias("_week")).distinct()


def replace_weeks(
    base: DataFrame, new: DataFrame, columns: Sequence[str] | None = None, week: str = WEEK,
) -> DataFrame:
    """New data wins by week: base rows of weeks not in ``new``, plus all of ``new``.

    The null week is a week like any other, so rows without a week are replaced, not doubled.
    """
    kept = base.join(staged(week_keys(new, week)), F.col(week).eqNullSafe(F.col("_week")), "left_anti")
    columns = list(columns or base.columns)
    return kept.select(*columns).unionByName(new.select(*columns))


def replace_recent_weeks(
    base: DataFrame, new: DataFrame, columns: Sequence[str] | None = None, week: str = WEEK, last: int = 12,
) -> DataFrame:
    """The older rule: only the latest weeks are replaced, yet all new rows are appended.

    Weeks of the delivery older than its ``last`` latest appear twice if base already had them;
    ``replace_weeks`` is the corrected rule.
    """
    recent = F.broadcast(latest_weeks(new, last, week))
    columns = list(columns or base.columns)
    return base.join(recent, week, "left_anti").select(*columns).unionByName(new.select(*columns))


def _winning_file(df: DataFrame, week: str, order: str, latest: bool) -> DataFrame:
    pick = F.max if latest else F.min
    winners = staged(df.groupBy(F.col(week).alias("_week")).agg(pick(order).alias("_order")))
    wins = F.col(week).eqNullSafe(F.col("_week")) & (F.col(order) == F.col("_order"))
    return df.join(winners, wins, "left_semi")


def latest_file_wins(df: DataFrame, week: str = WEEK, order: str = "file_order") -> DataFrame:
    """Keep, per week, the rows of the last file that delivered it.

    The winner per week comes from a staged aggregate, small enough to be broadcast by its size, so
    the rows are neither shuffled nor gathered by week.
    """
    return _winning_file(df, week, order, latest=True)


def first_file_wins(df: DataFrame, week: str = WEEK, order: str = "file_order") -> DataFrame:
    """Keep, per week, the rows of the first file that delivered it."""
    return _winning_file(df, week, order, latest=False)


def stack(*frames: DataFrame) -> DataFrame:
    """Bag union by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_positions(header: DataFrame, *sections: DataFrame) -> DataFrame:
    """Bag union by position under the first section's header."""
    return reduce(lambda a, b: a.union(b.toDF(*header.columns)), sections, header)


def side_by_side(left: DataFrame, right: DataFrame, order_left: str, order_right: str, n: int) -> DataFrame:
    """Pair the first ``n`` rows of two results row by row, in the order given; only those are numbered."""
    number = F.row_number()
    a = left.orderBy(order_left).limit(n).withColumn("_row", number.over(Window.orderBy(order_left)))
    b = right.orderBy(order_right).limit(n).withColumn("_row", number.over(Window.orderBy(order_right)))
    return a.join(b, "_row", "full_outer").drop("_row")


def missing_weeks(target: DataFrame, new: DataFrame, week: str = WEEK) -> DataFrame:
    """Rows of ``new`` whose week the target does not have; null is a week like any other."""
    return new.join(staged(week_keys(target, week)), F.col(week).eqNullSafe(F.col("_week")), "left_anti")


def next_missing_weeks(target: DataFrame, new: DataFrame, limit: int = 10, week: str = WEEK) -> DataFrame:
    """Rows of the first ``limit`` missing weeks, for back-filling in steps."""
    todo = missing_weeks(target, new.select(week).distinct(), week).orderBy(week).limit(limit)
    keys = staged(todo.select(F.col(week).alias("_week")))
    return new.join(keys, F.col(week).eqNullSafe(F.col("_week")), "left_semi")
