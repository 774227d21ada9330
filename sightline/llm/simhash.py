"""SimHash near-duplicates by tiled exact comparison of 64-bit fingerprints.

Fingerprints are dealt into tiles by the population counts of their words. Two fingerprints
within the radius have counts whose summed differences are within it too, so pairs of tiles
farther apart are skipped; the others are compared exactly with numpy exclusive-or and bit
counts. Equal fingerprints are compared once, so groups of copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Labels, checkpoint, over_batches, small_batches, sorted_runs
from .components import connected

SEED = 42
RADIUS = 2
SHINGLE = 3
#: Shingle hashes held at once while a long text is counted.
BLOCK = 1 << 18
#: Fingerprints of one tile that one task compares; larger tiles are split.
TILE_ROWS = 1 << 16
#: Cells of one exclusive-or table.
CELLS = 1 << 22

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACE = (np.arange(8) << 8).astype(np.int64)


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of word shingles, unsigned; a null text, or one without words, has zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), seed)
    total = len(words) - size + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, BLOCK):
        part = words[at : at + BLOCK + size - 1]
        hashes = np.array([digest(b" ".join(s), seed) for s in zip(*(part[k:] for k in range(size)))], dtype="<u8")
        cells = (hashes.view(np.uint8).reshape(-1, 8) + _PLACE).ravel()
        counts += (np.bincount(cells, minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(sum(1 << k for k in np.flatnonzero(2 * counts > total).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """(id, fingerprint as signed long, and the columns `keep`) of every row."""
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], names=[id_col, "fingerprint", *keep])

    kept = "".join(f", {k} {docs.schema[k].dataType.simpleString()}" for k in keep)
    return over_batches(docs, [id_col, text_col, *keep], run, f"{id_col} long, fingerprint long{kept}")


def words_for(n: int) -> int:
    """Words whose counts make a tile: more of them, hence more and smaller tiles, as rows grow."""
    return 3 if n < 5_000_000 else 4 if n < 100_000_000 else 8


def _tile(words: int) -> Column:
    """The population counts of the fingerprint's words as one number in base 65."""
    cuts = [round(64 * k / words) for k in range(words + 1)]
    total = F.lit(0).cast("long")
    for low, high in zip(cuts, cuts[1:]):
        mask = (1 << (high - low)) - 1
        total = total * 65 + F.bit_count(F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit(mask).cast("long"))).cast("long")
    return total


def _offsets(words: int, radius: int) -> list[int]:
    """Differences of tile numbers whose counts differ by at most `radius` in sum."""
    near = {0}
    for _ in range(radius):
        near |= {x + s * 65**k for x, k, s in product(near, range(words), (1, -1))}
    return sorted(near)


def near_links(values: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS, words: int | None = None) -> DataFrame:
    """(src, dst) links that span each set of distinct fingerprints joined within `radius` bits.

    `values(fingerprint)` holds distinct longs. Copies sent out grow with the rows, not their pairs,
    while a tile fits `tile_rows`; beyond, blocks of a tile's parts meet two at a time. `words` is as
    `words_for` the number of rows unless given; results are the same with any.
    """
    words = words or words_for(values.count())
    tiled = values.withColumn("tile", _tile(words))
    # At most one row for each vector of population counts: bounded by the tiling, not by the data.
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    own = tiled.join(sizes, "tile").withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    near = own.drop("parts").withColumn(
        "near", F.explode(F.array(*[F.lit(x).cast("long") for x in _offsets(words, radius)]) if radius else F.array(F.lit(0).cast("long")))
    )
    near = near.withColumn("near", F.col("tile") + F.col("near")).join(sizes.withColumnRenamed("tile", "near"), "near")
    near = near.withColumn("near_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    here, there = F.struct("tile", "part"), F.struct(F.col("near").alias("tile"), F.col("near_part").alias("part"))
    low, high = F.least(here, there), F.greatest(here, there)
    dealt = near.select(
        low["tile"].alias("a"), low["part"].alias("ap"), high["tile"].alias("b"), high["part"].alias("bp"), (here == low).alias("left"), "fingerprint"
    )
    keys = ["a", "ap", "b", "bp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, ap, b, bp, left, values in sorted_runs(batches, 4):
            found = values.to_numpy().view(np.uint64)
            left = left.to_numpy(zero_copy_only=False)
            same = a[0] == b[0] and ap[0] == bp[0]
            src, dst = compare(found if same else found[left], found if same else found[~left], radius)
            yield pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))], names=["src", "dst"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "src long, dst long")


def compare(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links spanning what joins the unsigned longs `a` and `b` within `radius` bits."""
    labels = Labels(len(a) + len(b))
    step = max(1, CELLS // max(1, len(b)))
    for at in range(0, len(a) if len(b) else 0, step):
        i, j = np.nonzero(np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius)
        labels.add(i + at, j + len(a))
    both = np.concatenate([a, b])
    low, high = labels.links()
    return both[low], both[high]


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, keep: Sequence[str] = ()) -> DataFrame:
    """(id, fingerprint long, component, component_id, and the columns `keep`) of every row of `docs`.

    component is one fingerprint of the group and never null; component_id is null where all ids of the group are.
    """
    found = checkpoint(fingerprints(docs, id_col, text_col, keep))
    classes = checkpoint(found.groupBy("fingerprint").agg(F.min(id_col).alias("low")))
    joined = connected(near_links(classes.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint")
    groups = classes.join(joined, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    lows = groups.groupBy("component").agg(F.min("low").alias("component_id"))
    members = groups.join(lows, "component").select("fingerprint", "component", "component_id")
    return found.join(members, "fingerprint").select(id_col, "fingerprint", "component", "component_id", *keep)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint long, component_id) of every row of `docs`.

    component_id is the smallest id reachable over fingerprints at most `radius` bits apart.
    Null or empty texts share fingerprint zero. Repeated ids stay as rows of their own; a null id
    gets the component of its fingerprint. An empty table gives an empty result.
    """
    return near_groups(docs, id_col, text_col, radius).select(id_col, "fingerprint", "component_id")
