"""Joining one row per group back to the group's members when groups may be huge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.session import lookup_side


def attach_to_members(
    members: DataFrame, groups: DataFrame, on: str, *, spread_by: str, size_col: str,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Inner join `groups` (one row per `on`, with its row count) to all member rows.

    A group above `hot_rows` is cut into ceil(size / hot_rows) parts by the hash of `spread_by`,
    and its group row is repeated once per part, so no task receives a whole hot group. The list of
    such groups is broadcast only within the bound that `lookup_side` checks.
    """
    parts = F.ceil(F.col(size_col) / F.lit(hot_rows)).cast("int")
    hot = lookup_side(groups.where(F.col(size_col) > hot_rows).select(on, parts.alias("_parts")))
    salted_members = (
        members.join(hot, on, "left")
        .withColumn(
            "_part",
            F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_parts").cast("bigint")), F.lit(0)),
        )
        .drop("_parts")
    )
    salted_groups = groups.withColumn(
        "_part",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(parts, F.lit(1)).cast("bigint") - 1)),
    )
    return salted_members.join(salted_groups, [on, "_part"]).drop("_part")


def looked_up(
    members: DataFrame, groups: DataFrame, on: str, *, how: str = "left", hot_rows: int = 1_000_000
) -> DataFrame:
    """Left or left-semi join of rows with a table of unique keys, where rows may repeat a key (null
    too) very often.

    Keys are counted first (counts combine before their shuffle). Rows of keys above `hot_rows` stay
    where they are and get their row of `groups` by a broadcast, within the bound that `lookup_side`
    checks; the others are joined.
    """
    sizes = members.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = lookup_side(sizes.select(F.col(on).alias("_hot")))
    if hot.isEmpty():
        return members.join(groups, on, how)
    same = F.col(on).eqNullSafe(F.col("_hot"))
    often = members.join(hot, same, "left_semi").join(lookup_side(groups.join(hot, same, "left_semi")), on, how)
    return often.unionByName(members.join(hot, same, "left_anti").join(groups, on, how))


# A group of more than this part of all rows is broadcast in `joined_by_size`.
HOT_SHARE = 1000


def joined_by_size(rows: DataFrame, groups: DataFrame, on: str, *, size: str, total: int) -> DataFrame:
    """Inner join of settled rows with a settled table of one row per group, which has its number of
    rows in `size`.

    Groups of more than a thousandth of all `total` rows are fewer than a thousand, so these are
    broadcast; the others are joined.
    """
    large = F.col(size) > total // HOT_SHARE
    hot = F.broadcast(groups.where(large))
    return rows.join(hot, on).unionByName(
        rows.join(hot.select(on), on, "left_anti").join(groups.where(~large), on)
    )
