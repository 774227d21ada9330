"""Row numbers within groups of any size (W8), and digests over such orders (A29): no task sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written


def numbered(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Add `name`: 1, 2, ... by `order` within `group`; null groups and orders are left out, rows that tie are numbered as they come."""
    known = rows.where(F.col(group).isNotNull() & F.col(order).isNotNull())
    return placed(known, group, [order], "_place", "_rows").withColumn(name, F.col("_place") + 1).drop("_place", "_rows")


def placed(rows: DataFrame, group: str, order: list[str], name: str = "place", total: str = "group_rows") -> DataFrame:
    """Add `name`, the place from 0 by `order` within `group`, and `total`, the group's rows. Nulls are values, and come first.

    Rows are sorted once over ranges of (group, order), as many as shuffles have partitions, and kept as a table. A
    place is that in the range, less the group's first there, plus the group's rows in earlier ranges.
    """
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id())
    spread = written(spread, "places").withColumn("_part", F.shiftrightunsigned("_at", 33))
    # A row for each group of each range.
    parts = spread.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_here"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_of"), (F.coalesce(F.sum("_here").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_here").over(Window.partitionBy(group)).alias(total)
    )
    found = spread.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return found.withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_of", "_group", "_shift")


def encoded(name: str) -> Column:
    """A column as its name, `=`, and `-` for null or else the count of UTF-8 bytes, a colon and the value as text."""
    text = F.col(name).cast("string")
    return F.concat(F.lit(f"{name}="), F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))


def ordered_digests(rows: DataFrame, group: str, order: list[str], fanout: int) -> DataFrame:
    """(group, rows, digest): sha256 over the rows of a group in the order of keys, then of what they hold, as a tree.

    Row hashes cover all columns, by name. Every `fanout` consecutive hashes, as hex text one after another, are
    hashed to one of the next level, until one is left; a single row is hashed once more too. The tree follows from
    places alone, so partitions don't show. Each level is that much smaller, and no task holds more than a range.
    """
    row = F.sha2(F.concat(*[encoded(n) for n in sorted(rows.columns)]), 256)
    narrow = rows.select(F.col(group).alias("_g"), *[F.col(k).alias(f"_k{n}") for n, k in enumerate(order)], row.alias("_h"))
    level = placed(narrow, "_g", [*(f"_k{n}" for n in range(len(order))), "_h"]).select("_g", "place", F.col("group_rows").alias("left"), F.col("group_rows").alias("rows"), "_h")
    done: DataFrame | None = None
    while True:
        up = level.groupBy("_g", F.expr(f"place div {fanout}").alias("place"), "left", "rows").agg(F.array_sort(F.collect_list(F.struct("place", "_h"))).alias("run"))
        digest = F.sha2(F.array_join(F.transform("run", lambda r: r["_h"]), ""), 256)
        level = written(up.select("_g", "place", F.expr(f"(left + {fanout - 1}) div {fanout}").alias("left"), "rows", digest.alias("_h")), "digests")
        top = level.where("left = 1").select(F.col("_g").alias(group), "rows", F.col("_h").alias("digest"))
        done = top if done is None else done.unionByName(top)
        level = level.where("left > 1")
        if level.isEmpty():
            return done
