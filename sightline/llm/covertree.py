"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are scaled to unit length, where a cosine bound is a radius. Cells of a bounded set of
pivots are the trees' first level, refined where cells are larger than a node. A vector stays in its cell and
visits those others that neither the plane between the pivots nor the covering radius rules out. For each
pair of nodes a task builds two trees of nested levels with halving radii and walks both at once: node
pairs beyond the radius are pruned, pairs wholly within it are counted at once, and what is left is
compared exactly: pair by pair, or by matrix products where nodes prune little.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Labels, checkpoint, small_batches, sorted_runs
from .components import connected
from .vectors import matrix, with_flag

COSINE = 0.95
#: Radii of the nested levels below a node, which is the level of radius 2: no two unit vectors are farther apart.
LEVELS = (1.0, 0.5, 0.25, 0.125)
#: Pivots of the first level, at most; so many cells there are even of few vectors, to give every core some.
PIVOTS, LEAST_CELLS = 2048, 16
#: How often pivots are refined.
ROUNDS = 4
#: Distinct vectors of one node; larger cells get more pivots, and parts by a hash where all pivots are given out.
NODE_ROWS = 32_768
#: Allowance for rounding in bounds; never in the decision itself.
SLACK = 1e-6
#: Members that show whether a level joins any, and the share of them that must have another within its radius.
PROBES, LEAST_MERGED = 128, 0.1
#: Radii above this are wide, and what a wide level's centres must hold to be of use.
WIDE, CLUSTER = 0.5, 8
#: Pairs whose vectors are gathered at once, child pairs of one step, cells of one matrix product.
GATHERED, PAIRS, DENSE = 1 << 14, 1 << 18, 1 << 22
#: How many pairs of a matrix product cost as much as one pair gathered by itself.
GATHER_COST = 12


class Level(NamedTuple):
    """Nodes of a tree: rows of their centres, covering radii, number of points below; node k holds `below[starts[k]:starts[k + 1]]`."""

    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray
    below: np.ndarray

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `nodes`, child) of each child."""
        count = self.starts[nodes + 1] - self.starts[nodes]
        owner = np.repeat(np.arange(len(nodes)), count)
        return owner, self.below[np.arange(len(owner)) + np.repeat(self.starts[nodes] - np.cumsum(count) + count, count)]


class CoverTree:
    """Levels of centres over unit vectors: a point belongs to the nearest centre within the level's radius."""

    def __init__(self, points: np.ndarray, levels: tuple[float, ...] = LEVELS):
        self.points, self.single = points, points.astype(np.float32)
        self.levels: list[Level] = []
        members, sizes = np.arange(len(points)), np.ones(len(points), dtype=np.int64)  # finest level first: its centres are the points of the next
        for radius in reversed(levels):
            centre_of = self._net(members, radius) if self._merges(members, radius) else members
            centres, place = np.unique(centre_of, return_inverse=True)
            spread = np.linalg.norm(points[members] - points[centre_of], axis=1)
            if self.levels:
                spread = spread + self.levels[-1].radii
            radii, held = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
            np.maximum.at(radii, place, spread)
            np.add.at(held, place, sizes)
            starts = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(centres)))])
            self.levels.append(Level(centres, radii, held, starts, np.argsort(place, kind="stable")))
            members, sizes = centres, held
        self.levels.reverse()

    def _merges(self, members: np.ndarray, radius: float) -> bool:
        """Whether a level of this radius would join members, by PROBES of them; if not, each stays its own centre, which bounds nothing less.

        Nodes of a wide level rule others out only where they are narrower than they may be, as in clusters: it
        must hold CLUSTER members to a centre.
        """
        if len(members) <= PROBES:
            return True
        dots = self.single[members[:: -(-len(members) // PROBES)]] @ self.single[members].T
        near = (2 - 2 * dots <= radius * radius).sum(axis=1)
        return float(np.mean(near > 1)) >= LEAST_MERGED if radius <= WIDE else float(np.median(near)) >= CLUSTER

    def _net(self, members: np.ndarray, radius: float) -> np.ndarray:
        """A centre for each member: greedy, so that centres are more than `radius` apart."""
        # Single precision will do: whatever centre is taken, covering radii are measured in double.
        points, out = self.single[members], np.full(len(members), -1)
        centres: list[int] = []
        for at in range(0, len(members), 512):
            block = points[at : at + 512]
            near = np.full(len(block), -1)
            if centres:
                dots = block @ points[centres].T
                best = dots.argmax(axis=1)
                close = 2 - 2 * dots[np.arange(len(block)), best] <= radius * radius
                near[close] = np.array(centres)[best[close]]
            left = np.flatnonzero(near < 0)
            inner = block[left] @ block[left].T
            free = np.ones(len(left), dtype=bool)
            for k in range(len(left)):
                if free[k]:
                    centres.append(at + int(left[k]))
                    taken = free & (2 - 2 * inner[k] <= radius * radius)
                    taken[k] = True
                    near[left[taken]] = centres[-1]
                    free &= ~taken
            out[at : at + len(block)] = members[near]
        return out

    def rows(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `nodes`, row) of all points below nodes of a level."""
        owner = np.arange(len(nodes))
        for at in self.levels[level:]:
            up, nodes = at.children(nodes)
            owner = owner[up]
        return owner, nodes


class Traversal:
    """Walks two trees at once; `na` and `nb` count the links of each point by the other's weight, `labels` joins rows of a, then of b."""

    def __init__(self, a: CoverTree, b: CoverTree, cosine: float, weights: tuple[np.ndarray, np.ndarray]):
        self.a, self.b, self.cosine, (self.wa, self.wb) = a, b, cosine, weights
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        #: Most that a product of unit vectors in single precision is off.
        self.band = 1.2e-7 * (a.points.shape[1] + 4)
        self.na, self.nb = np.zeros(len(a.points), dtype=np.int64), np.zeros(len(b.points), dtype=np.int64)
        self.shift = 0 if a is b else len(a.points)
        self.labels = Labels(self.shift + len(b.points))
        #: Node pairs that were looked at, and those of them that covering radii ruled out.
        self.met = self.pruned = 0

    def run(self) -> None:
        """The first level is every centre with every other: by blocks of a matrix product, pruned at once."""
        (ca, ra, *_), (cb, rb, *_) = self.a.levels[0], self.b.levels[0]
        right = self.b.single[cb].T
        for at in range(0, len(ca), 128):
            dots = self.a.single[ca[at : at + 128]] @ right
            # By the largest radii first, which is one bound for the whole block.
            i, j = np.divmod(np.flatnonzero(dots >= self._least(float(ra[at : at + 128].max() + rb.max()))), len(cb))
            near = dots[i, j] >= self._least(ra[i + at] + rb[j])
            i, j = i[near], j[near]
            self.met += dots.size
            self.pruned += dots.size - len(i)
            self._walk(0, i + at, j)

    def _least(self, reach: np.ndarray | float) -> np.ndarray | float:
        """The product, in single precision, below which centres with covering radii of this sum hold no links."""
        return 1 - (reach + self.radius + SLACK) ** 2 / 2 - 2 * self.band

    def _dots(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Products of rows i of a with rows j of b, in double precision."""
        return np.concatenate(
            [np.einsum("ij,ij->i", self.a.points[i[k : k + GATHERED]], self.b.points[j[k : k + GATHERED]]) for k in range(0, len(i), GATHERED)] or [np.zeros(0)]
        )

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.na, i, self.wb[j])
        np.add.at(self.nb, j, self.wa[i])
        self.labels.add(i, j + self.shift)

    def _whole(self, level: int, x: np.ndarray, y: np.ndarray) -> None:
        """All rows below nodes x link with all below nodes y."""
        (of_i, i), (of_j, j) = self.a.rows(level, x), self.b.rows(level, y)
        other = np.bincount(of_j, self.wb[j], len(x)).astype(np.int64), np.bincount(of_i, self.wa[i], len(x)).astype(np.int64)
        np.add.at(self.na, i, other[0][of_i])
        np.add.at(self.nb, j, other[1][of_j])
        first_i, first_j = i[np.searchsorted(of_i, np.arange(len(x)))], j[np.searchsorted(of_j, np.arange(len(x)))]
        self.labels.add(np.concatenate([i, first_i[of_j]]), np.concatenate([first_j[of_i], j]) + self.shift)

    def _walk(self, level: int, x: np.ndarray, y: np.ndarray) -> None:
        """Node pairs (x, y) of one level that may hold links; below the last level nodes are rows."""
        if level == len(self.a.levels):
            hit = self._dots(x, y) >= self.cosine
            self._link(x[hit], y[hit])
            return
        a, b = self.a.levels[level], self.b.levels[level]
        gap = np.sqrt(np.maximum(2 - 2 * self._dots(a.centres[x], b.centres[y]), 0))
        reach = a.radii[x] + b.radii[y]
        inside = gap + reach <= self.radius - SLACK
        for k in range(0, int(inside.sum()), 4096):
            self._whole(level, x[inside][k : k + 4096], y[inside][k : k + 4096])
        near = ~inside & (gap <= reach + self.radius + SLACK)
        self.met += len(near) if level else 0  # the first level's are counted where they are formed
        self.pruned += int((~inside & ~near).sum())
        x, y = x[near], y[near]
        if not len(x):
            return
        count = np.diff(a.starts)[x] * np.diff(b.starts)[y]
        every = int(a.sizes[np.unique(x)].sum()) * int(b.sizes[np.unique(y)].sum())
        if int(count.sum()) * GATHER_COST >= every:
            self._all(level, x, y)
            return
        # Pieces of about PAIRS child pairs, or a single node pair.
        piece = (np.cumsum(count) - count) // PAIRS
        for cut in np.split(np.arange(len(x)), np.flatnonzero(np.diff(piece)) + 1):
            u, v = x[cut], y[cut]
            wide = np.diff(b.starts)[v]
            owner = np.repeat(np.arange(len(cut)), count[cut])
            k = np.arange(len(owner)) - np.repeat(np.cumsum(count[cut]) - count[cut], count[cut])
            self._walk(level + 1, a.below[a.starts[u][owner] + k // wide[owner]], b.below[b.starts[v][owner] + k % wide[owner]])

    def _all(self, level: int, x: np.ndarray, y: np.ndarray) -> None:
        """Compare all rows below node pairs that prune little, by matrix products; products near the bound are taken anew in double precision."""
        xs, ys = np.unique(x), np.unique(y)
        asked = np.zeros((len(xs), len(ys)), dtype=bool)
        asked[np.searchsorted(xs, x), np.searchsorted(ys, y)] = True
        (of_i, rows_i), (of_j, rows_j) = self.a.rows(level, xs), self.b.rows(level, ys)
        right, step = self.b.single[rows_j].T, max(1, DENSE // len(rows_j))
        for at in range(0, len(rows_i), step):
            dots = self.a.single[rows_i[at : at + step]] @ right
            i, j = np.nonzero(dots >= self.cosine - self.band)
            sure = dots[i, j] >= self.cosine + self.band
            i = i + at
            keep = asked[of_i[i], of_j[j]]
            i, j, sure = rows_i[i[keep]], rows_j[j[keep]], sure[keep]
            sure[~sure] = self._dots(i[~sure], j[~sure]) >= self.cosine
            self._link(i[sure], j[sure])


def dual_traverse(a: CoverTree, b: CoverTree, cosine: float, weights: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of each point of a, of b, two ends of few links that span the components: rows of a, then those of b).

    A link counts the weight of the other point. With a is b, each point's own weight is left out.
    """
    found = Traversal(a, b, cosine, weights)
    found.run()
    low, high = found.labels.links()
    if a is b:  # every point met itself, and every pair came twice, once for each side
        own = found._dots(np.arange(len(a.points)), np.arange(len(a.points))) >= cosine
        return found.na - np.where(own, weights[0], 0), np.zeros(0, dtype=np.int64), low, high
    return found.na, found.nb, low, high


def near_duplicates(rows: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Null, zero or non-finite vectors, and vectors of different lengths, link with nothing. Equal
    vectors are compared once and linked by their number. Rows with a null id stay, without component.
    """
    spark = rows.sparkSession
    small_batches(spark, 4096)
    flagged = with_flag(rows, id_col, vector_col)
    # Repeated to an array, a norm is computed once a vector, not once a component. Where squares are lost or overflow,
    # the largest component becomes one first.
    over = lambda v, scale: F.zip_with(v, F.array_repeat(scale, F.size(v)), lambda x, n: x.cast("double") / n)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = flagged.where("usable").select("id", "vector", norm("vector").alias("norm"))
    largest = over("vector", F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    plain = F.col("norm").between(1e-140, 1e140)
    rows = rows.select("id", "norm", plain.alias("plain"), F.when(plain, F.col("vector").cast("array<double>")).otherwise(largest).alias("vector"))
    unit = rows.select("id", over("vector", F.when(F.col("plain"), F.col("norm")).otherwise(norm("vector"))).alias("vector"))
    distinct = checkpoint(unit.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    links = checkpoint(node_links(distinct, cosine))
    counts = links.where("dst is null").groupBy(F.col("src").alias("rep")).agg(F.sum("n").alias("others"))
    joined = connected(links.where("dst is not null").select("src", "dst")).select(F.col("node").alias("rep"), "component")
    groups = distinct.join(counts, "rep", "left").join(joined, "rep", "left")
    groups = groups.select(
        "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    linked = unit.join(groups, "vector").select("id", "n_links", "component_id")
    alone = flagged.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


class Cells:
    """The first level: each vector belongs to the nearest pivot; cells of other lengths than the pivots' are numbered by it, below zero."""

    def __init__(self, pivots: np.ndarray, cosine: float):
        self.pivots = pivots
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        gram = pivots @ pivots.T
        self.apart = np.sqrt(np.maximum(2 - 2 * gram, 0))
        #: Largest distance of a member from its pivot; unknown at first.
        self.radius = np.full(len(pivots), 2.0)
        k = np.arange(len(pivots))
        # Of two cells one visits the other, each about half of the others.
        self.visits = (k[:, None] != k[None]) & ((k[:, None] < k[None]) == ((k[:, None] + k[None]) % 2 == 0))

    def home(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance from its pivot, dot products with all pivots) of each vector; products only of those of the pivots' length."""
        size = self.pivots.shape[1]
        lengths = np.diff(vectors.offsets.to_numpy())
        fits = np.full(len(vectors), len(self.pivots) > 0) & (lengths == size)
        cell, gap = -lengths.astype(np.int64), np.zeros(len(vectors))
        dots = np.zeros((0, len(self.pivots)))
        if fits.any():
            dots = matrix(vectors.filter(pa.array(fits))) @ self.pivots.T
            best = dots.argmax(axis=1)
            cell[fits] = best
            gap[fits] = np.sqrt(np.maximum(2 - 2 * dots[np.arange(len(best)), best], 0))
        return cell, gap, dots

    def visited(self, cell: np.ndarray, dots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the other cells in which vectors may have links that are to be found there.

        A vector and any point of another cell lie on two sides of the plane between the pivots, and that
        point is no farther from its pivot than the covering radius: either bound rules a cell out.
        """
        own = dots[np.arange(len(cell)), cell]
        beyond = (own[:, None] - dots) > (self.reach + SLACK) * np.maximum(self.apart[cell], 1e-9) + SLACK
        far = np.sqrt(np.maximum(2 - 2 * dots, 0)) > self.radius[None] + self.reach + SLACK
        return np.nonzero(self.visits[cell] & ~beyond & ~far)


def _cells(distinct: DataFrame, cosine: float) -> tuple[Cells, dict[tuple[int, bool], int]]:
    """Cells, and the rows that each holds: (cell, whether as visitors) -> number.

    Pivots are a bounded sample of the vectors in the order of a hash: at most PIVOTS. Rounds add pivots from
    the cells that are still larger than a node.
    """
    total = distinct.count()
    wanted = min(PIVOTS, max(1, -(-total // NODE_ROWS), min(LEAST_CELLS, total // 64)))
    order = [F.xxhash64("rep"), "rep"]
    sample = [r["vector"] for r in distinct.orderBy(*order).limit(wanted).select("vector").collect()]
    size = max(map(len, sample), default=0)
    for left in reversed(range(ROUNDS)):
        cells = Cells(np.array([v for v in sample if len(v) == size], dtype=np.float64).reshape(-1, max(1, size)), cosine)
        at_home = _over(distinct, cells, _rows_home, "cell long, gap double")
        stats = at_home.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
        large = {r["cell"]: r["n"] for r in stats if r["n"] > NODE_ROWS and r["cell"] >= 0}
        more = min(sum(-(-2 * n // NODE_ROWS) for n in large.values()), PIVOTS - len(sample))
        if not left or not large or more <= 0:
            break
        crowded = _over(distinct, cells, _rows_all, "rep long, vector array<double>, cell long").where(F.col("cell").isin(list(large)))
        sample += [r["vector"] for r in crowded.orderBy(F.xxhash64("rep", F.lit(len(sample))), "rep").limit(more).select("vector").collect()]
    for r in stats:
        if r["cell"] >= 0:
            cells.radius[r["cell"]] = r["radius"] + SLACK
    visits = _over(distinct, cells, _rows_visit, "cell long").groupBy("cell").count().collect()
    return cells, {(r["cell"], False): r["n"] for r in stats} | {(r["cell"], True): r["count"] for r in visits}


def _over(distinct: DataFrame, cells: Cells, rows: Callable, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield rows(batch, cells)

    return distinct.select("rep", "copies", "vector").mapInArrow(run, schema)


def _rows_home(batch: pa.RecordBatch, cells: Cells) -> pa.RecordBatch:
    cell, gap, _ = cells.home(batch.column(2))
    return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(gap)], names=["cell", "gap"])


def _rows_all(batch: pa.RecordBatch, cells: Cells) -> pa.RecordBatch:
    cell, _, _ = cells.home(batch.column(2))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(cell)], names=["rep", "vector", "cell"])


def _rows_visit(batch: pa.RecordBatch, cells: Cells) -> pa.RecordBatch:
    cell, _, dots = cells.home(batch.column(2))
    _, other = cells.visited(cell[cell >= 0], dots)
    return pa.RecordBatch.from_arrays([pa.array(other.astype(np.int64))], names=["cell"])


def _rows_dealt(batch: pa.RecordBatch, cells: Cells) -> pa.RecordBatch:
    """Each row in its own cell, and as a visitor in those where it may have links."""
    cell, _, dots = cells.home(batch.column(2))
    inside = np.flatnonzero(cell >= 0)
    row, other = cells.visited(cell[inside], dots)
    take = pa.array(np.concatenate([np.arange(len(cell)), inside[row]]))
    where = pa.array(np.concatenate([cell, other]).astype(np.int64))
    visits = pa.array(np.arange(len(cell) + len(other)) >= len(cell))
    return pa.RecordBatch.from_arrays([where, visits, *(c.take(take) for c in batch.columns)], names=["cell", "visits", "rep", "copies", "vector"])


def dealt(distinct: DataFrame, cosine: float) -> DataFrame:
    """(cell, a, b, first, rep, copies, vector): the rows of each task, which is a pair (a, b) of parts of a cell.

    Residents of a cell fall into parts of about NODE_ROWS rows, numbered from 0, visitors into parts numbered
    on from there. Every part of residents meets itself, the later ones and all parts of visitors.
    """
    cells, sizes = _cells(distinct, cosine)
    own = sorted({c for c, _ in sizes})
    parts = [(c, max(1, -(-sizes.get((c, False), 0) // NODE_ROWS)), -(-sizes.get((c, True), 0) // NODE_ROWS)) for c in own]
    # One row for each cell: at most PIVOTS, and one for each other length of vectors.
    table = distinct.sparkSession.createDataFrame([tuple(map(int, p)) for p in parts] or [(0, 1, 0)], "cell long, residents int, visitors int")
    rows = _over(distinct, cells, _rows_dealt, "cell long, visits boolean, rep long, copies long, vector array<double>").join(F.broadcast(table), "cell")
    part = F.pmod(F.xxhash64("rep"), F.when(F.col("visits"), F.greatest("visitors", F.lit(1))).otherwise(F.col("residents"))).cast("int")
    rows = rows.withColumn("part", part + F.when(F.col("visits"), F.col("residents")).otherwise(F.lit(0)))
    here = F.col("part")
    to = lambda low, high, pair: F.when(low <= high, F.transform(F.sequence(low, high), pair)).otherwise(
        F.array().cast("array<struct<a: int, b: int, first: boolean>>")
    )
    as_first = lambda k: F.struct(here.alias("a"), k.alias("b"), F.lit(True).alias("first"))
    as_second = lambda k: F.struct(k.alias("a"), here.alias("b"), F.lit(False).alias("first"))
    resident = F.concat(to(here, F.col("residents") + F.col("visitors") - 1, as_first), to(F.lit(0), here - 1, as_second))
    visitor = to(F.lit(0), F.col("residents") - 1, as_second)
    return rows.select(
        "cell", F.explode(F.when(F.col("visits"), visitor).otherwise(resident)).alias("x"), "rep", "copies", "vector"
    ).select("cell", "x.*", "rep", "copies", "vector")


def node_links(distinct: DataFrame, cosine: float) -> DataFrame:
    """(src, dst, n): with dst null, n links of src found in one task; else a link of components."""
    keys = ["cell", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, a, b, first, reps, copies, vectors in sorted_runs(batches, 3):
            first, reps, copies, points = first.to_numpy(zero_copy_only=False), reps.to_numpy(), copies.to_numpy(), matrix(vectors)
            if a[0] == b[0]:
                tree = CoverTree(points)
                counts, _, low, high = dual_traverse(tree, tree, cosine, (copies, copies))
                own = reps
            elif first.all() or not first.any():
                continue
            else:
                x, y = CoverTree(points[first]), CoverTree(points[~first])
                na, nb, low, high = dual_traverse(x, y, cosine, (copies[first], copies[~first]))
                own, counts = np.concatenate([reps[first], reps[~first]]), np.concatenate([na, nb])
            hit = counts > 0
            src, dst = own[low], own[high]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([own[hit], src])), pa.array([None] * int(hit.sum()) + dst.tolist(), pa.int64()),
                    pa.array(np.concatenate([counts[hit], np.zeros(len(src), dtype=np.int64)]))
                ],
                names=["src", "dst", "n"]
            )

    return dealt(distinct, cosine).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "src long, dst long, n long")

