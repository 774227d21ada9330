"""Merkle manifest of a table: one tree a group, one tree over the groups' roots, by slot pivots.

A level is a grouped pivot: conditional aggregates spread the children of a parent into `fanout`
columns, one a slot. Concatenating the columns and hashing gives the parent; concatenating them
without a child's own column gives that child's siblings. Everything is native: texts are read once
and never shuffled, hashes travel as 32 bytes, and each later level is `fanout` times smaller.

A group may hold any share of the rows: places in it come from one sort by ranges, and all later
keys are (group, place of the parent), so no task holds more than a range of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

FANOUT = 16
STEP = "struct<left:binary,right:binary>"


def _nothing() -> Column:
    return F.lit(bytearray())


def digest(value: Column) -> Column:
    """sha256 of binary, of its lowercase hex text, as 32 bytes."""
    return F.unhex(F.sha2(F.lower(F.hex(value)), 256))


def encoded(value: Column) -> Column:
    """`-` for null, else the count of UTF-8 bytes, a colon and the value; numbers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """32-byte hash of a row's columns, encoded one after another."""
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns]), 256))


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `idx`, the place from 0 within `key` by `order`, and `n`, the rows of the key.

    Rows are sorted once over ranges of (key, order) and kept as a table. A place is then the place in
    the range, less that of the key's first row there, plus the key's rows in earlier ranges.
    """
    spread = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order).withColumn("at", F.monotonically_increasing_id())
    spread = written(spread, "merkle-places").withColumn("part", F.shiftrightunsigned("at", 33))
    # One row for each key of each range.
    parts = spread.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0))).withColumn("n", F.sum("here").over(Window.partitionBy("key")))
    return (
        spread.join(parts.drop("here"), ["key", "part"]).withColumn("idx", F.col("at") - F.col("first") + F.col("before"))
        .drop("at", "part", "first", "before")
    )


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """(key, idx, under, n, hash, c0..) of the parents of `nodes(key, idx, n, hash, ...)`.

    `under` counts the key's nodes of the level below, `n` those of this level; c_k is the child of
    slot k with its hash and other columns. A key's only leaf is its own parent, unhashed.
    """
    carried = ", ".join(c for c in nodes.columns if c not in ("key", "idx", "n"))
    slots = [F.expr(f"max(if(idx % {fanout} = {k}, struct({carried}), null)) AS c{k}") for k in range(fanout)]
    out = nodes.groupBy("key", F.expr(f"idx div {fanout} AS parent")).agg(F.max("n").alias("under"), *slots)
    whole = f"unhex(sha2(lower(hex(concat({_hashes(range(fanout))}))), 256))"
    return out.selectExpr(
        "key", "parent AS idx", "under", f"(under + {fanout - 1}) div {fanout} AS n", f"if(under = 1, c0.hash, {whole}) AS hash", *[f"c{k}" for k in range(fanout)]
    )


def _hashes(slots: Iterable[int]) -> str:
    """SQL for the arguments of a concatenation of slots' hashes; slots after the last child are empty."""
    return ", ".join([f"coalesce(c{k}.hash, X'')" for k in slots] or ["X''"])


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The parents of `nodes` level by level, each a table, until every key has one node."""
    out = [written(_pivot(nodes, fanout), "merkle-level")]
    while True:
        # One number: the most nodes that a key has left.
        most = out[-1].agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return out
        out.append(written(_pivot(out[-1].where("n > 1").select("key", "idx", "n", "hash"), fanout), "merkle-level"))


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(key, hash) of the last node of each key."""
    tops = [level.where("n = 1").select("key", "hash") for level in levels]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _descend(level: DataFrame, paths: DataFrame, fanout: int) -> DataFrame:
    """The children of the nodes of `level`, each with its siblings put before its parent's path."""
    children = ", ".join(
        f"if(c{k} IS NULL, null, struct({k}L AS slot, c{k} AS child,"
        f" struct(concat({_hashes(range(k))}) AS left, concat({_hashes(range(k + 1, fanout))}) AS right) AS step))" for k in range(fanout)
    )
    rows = level.drop("hash", "n").join(paths, ["key", "idx"])
    rows = rows.select("key", "idx", "under", "subroot", "path", F.expr(f"explode(filter(array({children}), m -> m IS NOT NULL)) AS m"))
    path = F.when(F.col("under") == 1, F.col("path")).otherwise(F.concat(F.array(F.col("m.step")), F.col("path")))
    return rows.select("key", (F.col("idx") * fanout + F.col("m.slot")).alias("idx"), "subroot", path.alias("path"), "m.child.*")


def _paths(levels: list[DataFrame], starts: DataFrame, fanout: int) -> DataFrame:
    """The lowest nodes with their paths to the key's last node, followed by the path of `starts(key, subroot, path)`."""
    above: DataFrame | None = None
    for level in reversed(levels):
        here = level.where("n = 1").select("key", "idx").join(starts, "key")
        if above is not None:
            here = here.unionByName(above.select("key", "idx", "subroot", "path"))
        above = _descend(level, here, fanout)
    return above


def manifest(
    rows: DataFrame, columns: Sequence[str], id_col: str, group_col: str, fanout: int = FANOUT, changed: Sequence[Column] | None = None
) -> DataFrame:
    """(id, leaf, changed_leaf, subroot, root, path) of each row; hashes are 32 bytes.

    `path` holds for each level (left, right): the siblings' hashes before and after, one after another,
    first in the row's group, then among the groups. `changed` are other columns for the same rows;
    `changed_leaf` is their hash, or null where it is the same.

    Leaves ascend by id, null ids first, equal ids by leaf; rows equal in all `columns` stand side by
    side and may share each other's places. Groups ascend by UTF-8 bytes, the null group first. A group
    of one row has that leaf as its subroot, a table of one group its subroot as root, with nothing to
    add to a path. Empty text is not null. A table without rows gives none. Other columns are ignored.
    """
    hashes = rows.select(
        # Sorts as the group does, and is never null.
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("key"), F.col(id_col).alias("id"),
        leaf([F.col(c) for c in columns]).alias("hash"), (leaf(changed) if changed else F.lit(None).cast("binary")).alias("other")
    )
    hashes = hashes.withColumn("other", F.when(F.col("other") != F.col("hash"), F.col("other")))
    # Kept before the sort, whose sample would hash all texts once more. `row` parts ranges of equal rows.
    hashes = written(hashes.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    levels = _levels(_placed(hashes, ["id", "hash", "row"]).select("key", "idx", "n", "hash", "id", "other"), fanout)
    groups = _tops(levels).select(F.lit("").alias("key"), F.col("key").alias("group"), "hash")
    upper = _levels(_placed(groups, ["group"]), fanout)
    root = _tops(upper).select("hash").first()
    root = root["hash"] if root else None
    start = rows.sparkSession.range(1).select(F.lit("").alias("key"), F.lit(None).cast("binary").alias("subroot"), F.array().cast(f"array<{STEP}>").alias("path"))
    starts = _paths(upper, start, fanout).select(F.col("group").alias("key"), F.col("hash").alias("subroot"), "path")
    found = _paths(levels, starts, fanout)
    return found.select(
        F.col("id").alias(id_col), F.col("hash").alias("leaf"), F.col("other").alias("changed_leaf"), "subroot", F.lit(root).cast("binary").alias("root"), "path"
    )


def siblings(path: Column) -> Column:
    """All siblings of a path, from left to right and level by level, as bytes."""
    return F.aggregate(path, _nothing(), lambda a, step: F.concat(a, step["left"], step["right"]))


def folded(hashed: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of `path`."""
    return F.aggregate(path, hashed, lambda a, step: digest(F.concat(step["left"], a, step["right"])))


def verified(found: DataFrame) -> DataFrame:
    """Add proof (hash of all siblings), folded_root (from changed_leaf where there is one, else from leaf) and verified."""
    back = folded(F.coalesce("changed_leaf", "leaf"), F.col("path"))
    return found.withColumn("proof", digest(siblings(F.col("path")))).withColumn("folded_root", back).withColumn("verified", F.col("folded_root") == F.col("root"))
