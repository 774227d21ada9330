"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees on a bounded sample of labelled documents give paths, each a conjunction of
thresholds; a lasso logistic fit keeps few of them; those are compiled into Spark columns.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import over_batches, small_batches, text_remainder

#: Bound of the fit: labelled documents, half of them of either label where there are as many.
FIT_DOCS = 6000
TREES, DEPTH = 40, 3
THRESHOLD = 0.3
#: Statistics of a whole text.
STATISTICS = (
    "n_chars", "n_words", "mean_word", "upper", "digits", "symbols", "marks", "bars", "blanks", "distinct_words", "distinct_lines", "symbol_words",
    "repeated_pairs", "mean_line"
)

_KIND = np.full(256, 6, dtype=np.int64)  # other
_KIND[[*range(97, 123), *range(128, 256)]] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_KIND[ord("|")] = 5
_ENDS_ODD = re.compile(r"[^\w\s.,;:!?'\"()-]$")


def statistics(text: str) -> tuple[float, ...]:
    """STATISTICS of one whole text; all zero for empty text."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = len(data)
    if not n:
        return (0.0,) * len(STATISTICS)
    kinds = np.bincount(_KIND[data], minlength=7)
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    count = max(1, len(words))
    letters = max(1, kinds[0] + kinds[1])
    odd = sum(1 for w in words if _ENDS_ODD.search(w) or w.endswith("!!"))
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    return (
        float(n), float(len(words)), n / count, kinds[1] / letters, kinds[2] / n, kinds[6] / n, kinds[4] / n, kinds[5] / n, kinds[3] / n,
        len(set(words)) / count, len(set(lines)) / max(1, len(lines)), odd / count, repeated / count, n / max(1, len(lines)),
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, *STATISTICS as doubles) of every row; null texts are empty."""
    small_batches(docs.sparkSession)
    columns = [id_col, *(keep or [])]
    narrow = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema] + [f"__{s} double" for s in STATISTICS])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t or "") for t in batch.column(len(columns)).to_pylist()], dtype=np.float64).reshape(-1, len(STATISTICS))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *(pa.array(c) for c in rows.T)], names=[*columns, *(f"__{s}" for s in STATISTICS)])

    return over_batches(narrow, narrow.columns, run, schema)


class Rule(NamedTuple):
    """A conjunction: each part is (statistic, 'le' or 'gt', threshold)."""

    parts: tuple[tuple[int, str, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, [x[:, k] <= t if op == "le" else x[:, k] > t for k, op, t in self.parts])

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"__{STATISTICS[k]}") <= t if op == "le" else F.col(f"__{STATISTICS[k]}") > t for k, op, t in self.parts])


class RuleEnsemble(NamedTuple):
    bias: float
    rules: list[Rule]
    weights: list[float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.bias + sum((w * r.holds(x) for r, w in zip(self.rules, self.weights)), np.zeros(len(x)))
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The score as one Spark column over the statistics."""
        terms = [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.bias))))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int, path: tuple, out: list) -> np.ndarray:
    """A second-order regression tree; adds every node's path to `out`, returns the leaf values of the rows."""
    value = np.full(len(x), -g.sum() / (h.sum() + 1.0))
    if path:
        out.append(Rule(path))
    if not depth or len(x) < 10:
        return value
    best, gain = None, 1e-3
    whole = g.sum() ** 2 / (h.sum() + 1)
    for k, at in enumerate(cuts):
        if not len(at):
            continue
        place = np.searchsorted(at, x[:, k], side="left")  # place <= j exactly where x <= at[j]
        gs, hs = (np.cumsum(np.bincount(place, weights=v, minlength=len(at) + 1))[:-1] for v in (g, h))
        score = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
        j = int(score.argmax())
        if score[j] > gain:
            best, gain = (k, float(at[j])), score[j]
    if best is None:
        return value
    k, t = best
    left = x[:, k] <= t
    for side, op in ((left, "le"), (~left, "gt")):
        if side.any():
            value[side] = _grow(x[side], g[side], h[side], cuts, depth - 1, (*path, (k, op, t)), out)
    return value


def fit_rules(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = 2e-4, seed: int = 5, steps: int = 600
) -> RuleEnsemble:
    """Rules from boosted trees on random halves, then lasso logistic weights by accelerated proximal steps."""
    weight = weight / weight.sum()
    prior = float(np.clip((weight * y).sum(), 1e-3, 1 - 1e-3))
    if len(set(y.tolist())) < 2:
        return RuleEnsemble(float(np.log(prior / (1 - prior))), [], [])
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 33))) for k in range(x.shape[1])]
    rng, margin, found = np.random.default_rng(seed), np.full(len(x), np.log(prior / (1 - prior))), []
    scale = weight * len(x)
    for _ in range(trees):
        half = rng.random(len(x)) < 0.5
        p = 1 / (1 + np.exp(-margin))
        g, h = scale * (p - y), scale * p * (1 - p)
        part: list[Rule] = []
        _grow(x[half], g[half], h[half], cuts, depth, (), part)
        values = np.zeros(len(x))
        grown = [r for r in part]
        found += grown
        # The step of boosting itself: mean Newton step of the rows under each deepest path.
        for rule in grown:
            under = rule.holds(x)
            values[under] = -g[under & half].sum() / (h[under & half].sum() + 1.0)
        margin = margin + 0.3 * values
    rules, seen = [], set()
    for rule in dict.fromkeys(found):
        mask = rule.holds(x)
        key = mask.tobytes()
        if key not in seen and 0.001 < (weight * mask).sum() < 0.999:
            seen.add(key)
            rules.append(rule)
    if not rules:
        return RuleEnsemble(float(np.log(prior / (1 - prior))), [], [])
    a = np.column_stack([r.holds(x) for r in rules]).astype(np.float64)
    centre, spread = weight @ a, np.sqrt(np.maximum(weight @ (a * a) - (weight @ a) ** 2, 1e-9))
    a = (a - centre) / spread
    root, top = rng.normal(size=a.shape[1]), 1.0
    for _ in range(20):  # largest curvature, by power iteration
        root = a.T @ (weight * (a @ root))
        top = max(np.linalg.norm(root), 1e-9)
        root /= top
    rate = 1 / (0.25 * top + 0.25)
    w, bias, ahead, t = np.zeros(a.shape[1]), float(np.log(prior / (1 - prior))), np.zeros(a.shape[1]), 1.0
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-(a @ ahead + bias))) - y)
        step = ahead - rate * (a.T @ error)
        fresh = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        bias -= rate * error.sum()
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = fresh + (t - 1) / later * (fresh - w), fresh, later
    kept = np.flatnonzero(w)
    real = w[kept] / spread[kept]
    return RuleEnsemble(float(bias - (real * centre[kept]).sum()), [rules[k] for k in kept], real.tolist())


def sample_labels(labels: DataFrame, id_col: str, label_col: str, bound: int) -> DataFrame:
    """(id, label, share): at most `bound` learnable ids, half of them of each label as far as there are,
    in the order of a hash of the id; `share` is how many labelled rows one sampled row stands for."""
    rows = labels.where(
        F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (text_remainder(id_col, 5) != 0)
    ).select(id_col, F.col(label_col).cast("int").alias("label"))
    rows = rows.groupBy(id_col).agg(F.min("label").alias("label"))
    parts = []
    for value in (0, 1):
        own = rows.where(F.col("label") == value)
        total = own.count()
        taken = min(total, bound // 2)
        parts.append(own.orderBy(F.xxhash64(id_col), id_col).limit(bound // 2).withColumn("share", F.lit(total / max(1, taken))))
    return parts[0].unionByName(parts[1])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bound: int = FIT_DOCS
) -> RuleEnsemble:
    """Fit on the whole texts of a bounded sample of labelled documents; only their statistics reach the driver.

    Labels other than 0 and 1, null ids and ids with crc32 divisible by 5 are not learnt from.
    Without labels the score is 0.5 everywhere.
    """
    chosen = sample_labels(labels, id_col, label_col, bound)
    known = with_statistics(docs.select(id_col, text_col).join(F.broadcast(chosen), id_col), id_col, text_col, ["label", "share"])
    # Of rows that repeat an id the one with the least statistics counts.
    names = ["label", "share", *(f"__{s}" for s in STATISTICS)]
    rows = known.groupBy(id_col).agg(F.min(F.struct(*names)).alias("least")).select(id_col, "least.*").orderBy(id_col).toPandas()
    if not len(rows):
        return RuleEnsemble(0.0, [], [])
    return fit_rules(rows[[f"__{s}" for s in STATISTICS]].to_numpy(), rows["label"].to_numpy(), rows["share"].to_numpy())


def score(
    docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """(id, *keep, score, predicted) of every row, from the whole text alone; null texts score as empty ones."""
    scored = with_statistics(docs, id_col, text_col, keep).withColumn("score", model.column())
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop(*[f"__{s}" for s in STATISTICS])
