"""Approximate nearest neighbours with a forest of hash prefixes.

Rows are dealt into shards of bounded size. A shard holds, for each tree, the sorted array of its
rows' long hash strings (one bit for the side of each random plane). A query starts in every tree from
its own string and from those with its least certain bits turned round, and descends to the longest
matching prefixes. Then all trees ascend together, a bit at a time, until the matching stretches hold
enough candidates; those are compared exactly. Queries go to every shard in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, sorted_runs
from .vectors import matrix, usable

TREES, BITS = 32, 32
#: Rows of a shard and queries of a block, at most on average; smaller tables make SHARDS shards of at least LEAST_ROWS rows.
SHARD_ROWS, BLOCK_QUERIES, SHARDS, LEAST_ROWS = 200_000, 10_000, 12, 16_000
NEIGHBOURS = 10


def wanted(rows: int) -> int:
    """Candidates (with repeats) at which the ascent in a shard of `rows` rows ends.

    The share falls with the 0.43th power of the rows: measured on vectors without any structure, the
    hardest case, where it holds recall above 0.9. Up to some 1,000 rows nearly all are compared.
    """
    return int(max(256, 0.75 * rows * (2000 / max(rows, 1)) ** 0.43))


def starts(rows: int) -> int:
    """Strings that a query starts from in each tree: more of them as arrays grow, so that prefixes stay long."""
    return int(np.clip(64 * (rows / 2000) ** 0.43, 32, 512))


def turns(count: int, most: int = 12) -> list[tuple[int, ...]]:
    """Sets of bits to turn round, by the rank of their certainty, likeliest first; the empty set leads."""
    sets = [c for size in range(5) for c in combinations(range(most), size)]
    return sorted(sets, key=lambda c: (sum((k + 1) ** 2 for k in c), c))[:count]


class PrefixForest:
    """Sorted arrays of hash strings over the rows of one shard."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 17):
        self.rows, self.bits, self.trees = rows, bits, trees
        self.planes = self._planes(rows.shape[1], trees, bits, seed)
        #: The trees' sorted arrays one after another, the tree's number above each string, and the rows that have them.
        self.sorted, self.order = np.empty((trees, len(rows)), dtype=np.int64), np.empty((trees, len(rows)), dtype=np.int32)
        for at in range(0, len(rows), 4096):
            self.sorted[:, at : at + 4096] = self._strings(self.sides(rows[at : at + 4096]) > 0).T
        for tree, (strings, order) in enumerate(zip(self.sorted, self.order)):
            order[:] = np.argsort(strings, kind="stable")
            strings[:] = strings[order] + (tree << bits)
        self.sorted, self.order = self.sorted.ravel(), self.order.ravel()

    @staticmethod
    def _planes(size: int, trees: int, bits: int, seed: int) -> np.ndarray:
        """Random planes; those of one tree at right angles to each other as far as there are dimensions."""
        rng = np.random.default_rng(seed)
        made = []
        for _ in range(trees):
            got = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-bits // max(1, size)))]
            made.append(np.concatenate(got, axis=1)[:, :bits])
        return np.concatenate(made, axis=1).astype(np.float32) if made else np.zeros((size, 0), dtype=np.float32)

    def sides(self, rows: np.ndarray) -> np.ndarray:
        """Signed distance of each row from each plane: (row, tree, bit)."""
        return (rows.astype(np.float32) @ self.planes).reshape(len(rows), self.trees, self.bits)

    def _strings(self, sides: np.ndarray) -> np.ndarray:
        """Bits as numbers, the first bit highest."""
        return sides @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def probes(self, query: np.ndarray, depth: int, sets: list[tuple[int, ...]]) -> np.ndarray:
        """(tree, start): the query's strings with sets of its least certain bits of the first `depth` turned round."""
        sides = self.sides(query[None])[0]
        own = self._strings(sides > 0)
        rank = np.argsort(np.abs(sides[:, :depth]), axis=1, kind="stable")
        place = 1 << (self.bits - 1 - rank)
        change = np.zeros((self.trees, len(sets)), dtype=np.int64)
        for k, turned in enumerate(sets):
            # Certainty ranks beyond the prefix have no bit to turn; such starts repeat others and add no row.
            for r in turned:
                if r < place.shape[1]:
                    change[:, k] |= place[:, r]
        return own[:, None] ^ change

    def candidates(self, query: np.ndarray, least: int, distinct: int, depth: int, sets: list[tuple[int, ...]]) -> np.ndarray:
        """Rows in the stretches of one query, in order: ascend from the full strings until `least` rows are held with repeats, and `distinct` ones."""
        strings = self.probes(query, depth, sets) + (np.arange(self.trees, dtype=np.int64) << self.bits)[:, None]
        seen = np.zeros(len(self.rows), dtype=bool)
        for length in range(min(self.bits, depth + 2), -1, -1):
            cut = self.bits - length
            prefix = np.unique(strings >> cut)
            low, high = np.searchsorted(self.sorted, prefix << cut), np.searchsorted(self.sorted, (prefix + 1) << cut)
            size = high - low
            if size.sum() < least and length:
                continue
            seen[self.order[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]] = True
            if np.count_nonzero(seen) >= distinct:
                break
        return np.flatnonzero(seen)


def search(
    keys: np.ndarray, rows: np.ndarray, query_keys: np.ndarray, queries: np.ndarray, k: int = NEIGHBOURS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query's place, row's place, distance) of up to k nearest candidates of each query, and how many rows were compared.

    A row whose key is the query's is the query itself. Of equal distances the earlier row comes first.
    """
    least = min(wanted(len(rows)), len(rows))
    distinct = min(len(rows), 4 * k + 1)
    sets = turns(starts(len(rows)))
    # The depth at which evenly filled arrays hold the wanted rows.
    depth = int(np.clip(np.ceil(np.log2(max(1.0, TREES * len(sets) * len(rows) / max(1, least)))), 1, BITS))
    forest = PrefixForest(rows)
    of, found, far, compared = [], [], [], 0
    for q in range(len(queries)):
        near = forest.candidates(queries[q], least, distinct, depth, sets)
        compared += len(near)
        near = near[keys[near] != query_keys[q]]
        gap = rows[near] - queries[q]
        distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        if len(near) > k:  # all that tie with the k-th stay until their places decide
            keep = distance <= np.partition(distance, k - 1)[k - 1]
            near, distance = near[keep], distance[keep]
        best = np.argsort(distance, kind="stable")[:k]
        of.append(np.full(len(best), q))
        found.append(near[best])
        far.append(distance[best])
    return (*(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (of, found, far)), compared)


def nearest(rows: DataFrame, every: int = 100, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score) for each row whose id is divisible by `every`: its k nearest of all other rows found.

    score is the Euclidean distance in double precision; ties go to the smaller id. Only vectors of
    the query's own length are compared. Unusable vectors take no part. Rows are points whatever their
    ids: those that repeat an id, with the same vector or another, are each other's candidates, and
    each that asks has its own ranks.
    """
    small_batches(rows.sparkSession, 4096)
    # A row's place in the table tells it from others of its id. It is computed where rows are read, so both uses agree.
    good = usable(rows, id_col, vector_col).withColumn("size", F.size("vector")).withColumn("key", F.monotonically_increasing_id())
    asked = good.where(F.col("id") % every == 0)
    total = good.agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    shards = max(-(-total["n"] // SHARD_ROWS), min(SHARDS, -(-total["n"] // LEAST_ROWS)), 1)
    blocks = max(1, -(-total["q"] // BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = good.select("size", shard.alias("shard"), numbers(blocks).alias("block"), F.lit(False).alias("asks"), "id", "key", "vector")
    queries = asked.select("size", numbers(shards).alias("shard"), block.alias("block"), F.lit(True).alias("asks"), "id", "key", "vector")
    groups = ["size", "shard", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, asks, ids, keys, vectors in sorted_runs(batches, 3):
            # Rows lie in order of (asks, id, key).
            asks, ids, keys, vectors = asks.to_numpy(zero_copy_only=False), ids.to_numpy(), keys.to_numpy(), matrix(vectors)
            if asks.all() or not asks.any():
                continue
            of, found, far, _ = search(keys[~asks], vectors[~asks], keys[asks], vectors[asks], k)
            columns = [keys[asks][of], ids[asks][of], keys[~asks][found], ids[~asks][found]]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c.astype(np.int64)) for c in columns), pa.array(far)], names=["query_key", "query_id", "key", "vec_id", "score"]
            )

    near = index.unionByName(queries).repartition(*groups).sortWithinPartitions(*groups, "asks", "id", "key").mapInArrow(
        run, "query_key long, query_id long, key long, vec_id long, score double"
    )
    order = Window.partitionBy("query_key").orderBy("score", "vec_id", "key")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
