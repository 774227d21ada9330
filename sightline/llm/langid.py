"""Language identification by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows, followed by max pooling
and a softmax, all in numpy. A filter of width w over one-hot byte classes is a sum of weights,
so trained filters are folded into tables over pairs of classes: two look-ups give a width of 4.
Whole texts are cut into windows, which are scored in batches; a text's score is their mean.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import over_batches, small_batches, text_remainder

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bound of the fit: documents of each language, of all languages together, slices of each document.
DOCS_PER_LANGUAGE, DOCS = 400, 25_600
SLICES_PER_DOC = 4
#: Bytes that the last window of a slice must fill to be learnt from.
LEAST_BYTES = 128
#: Languages, at most, whose sizes are sent to all tasks.
SENT = 10_000
EPOCHS = 8
#: Windows scored at once.
SLICE = 512
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def byte_classes() -> np.ndarray:
    """Class of each byte: a blank for all of ASCII but letters (case folded), then one for each high byte."""
    table = np.zeros(256, dtype=np.uint8)
    for k in range(26):
        table[97 + k] = table[65 + k] = k + 1
    table[128:] = np.arange(27, 27 + 128)
    return table


CLASSES = 27 + 128
_CLASS = byte_classes()


def windows(text: str, size: int = WINDOW) -> np.ndarray:
    """Byte classes of the whole text, one byte each, in windows of `size`; the last is filled with blanks."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    out = np.zeros(-(-len(data) // size) * size, dtype=np.uint8)
    out[: len(data)] = _CLASS[data]
    return out.reshape(-1, size)


def _pairs(x: np.ndarray) -> np.ndarray:
    """Each class with the one after it as one number."""
    pairs = x.astype(np.int32) * CLASSES
    pairs[:, :-1] += x[:, 1:]
    return pairs


class ByteNet:
    """The network: `weights[w]` is (width, class, filter), `dense` (features, language)."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.weights = [rng.normal(0, 0.3 / np.sqrt(w), (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        self.dense = rng.normal(0, 0.1, (len(self.bias), len(languages))).astype(np.float32)
        self.shift = np.zeros(len(languages), dtype=np.float32)
        self.fold()

    def fold(self) -> None:
        """Tables over class pairs: filters of width w as sums of them."""
        self.tables = []
        for weight in self.weights:
            parts = []
            for k in range(0, len(weight), 2):
                pair = weight[k][:, None, :] + (weight[k + 1][None] if k + 1 < len(weight) else np.zeros_like(weight[k])[None])
                parts.append((k, np.ascontiguousarray(pair.reshape(CLASSES * CLASSES, FILTERS))))
            self.tables.append(parts)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and where it starts."""
        pairs = _pairs(x)
        best, where = [], []
        for weight, parts in zip(self.weights, self.tables):
            n = x.shape[1] - len(weight) + 1
            response = sum(np.take(table, pairs[:, k : k + n], axis=0) for k, table in parts)
            at = response.argmax(axis=1)
            best.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
            where.append(at)
        return np.concatenate(best, axis=1), np.concatenate(where, axis=1)

    def largest(self, x: np.ndarray) -> np.ndarray:
        """As `pooled`, without the places: windows are scored a position at a time, all filters at once."""
        pairs = _pairs(x)
        out = []
        for weight, parts in zip(self.weights, self.tables):
            n = x.shape[1] - len(weight) + 1
            response = np.take(parts[0][1], pairs[:, :n], axis=0)
            for k, table in parts[1:]:
                response += np.take(table, pairs[:, k : k + n], axis=0)
            out.append(response.max(axis=1))
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax(np.maximum(self.largest(x) + self.bias, 0) @ self.dense + self.shift)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01, seed: int = 11) -> ByteNet:
        """Adam on the cross-entropy; the gradient of a maximum flows to where it was taken."""
        rng = np.random.default_rng(seed)
        params = [*self.weights, self.bias, self.dense, self.shift]
        mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                self.fold()
                top, where = self.pooled(x[rows])
                hidden = np.maximum(top + self.bias, 0)
                error = _softmax(hidden @ self.dense + self.shift)
                error[np.arange(len(rows)), y[rows]] -= 1
                error /= len(rows)
                back = (error @ self.dense.T) * (hidden > 0)
                grads = []
                for k, weight in enumerate(self.weights):
                    own = slice(k * FILTERS, (k + 1) * FILTERS)
                    grad = np.zeros_like(weight)
                    for p in range(len(weight)):
                        seen = np.take_along_axis(x[rows], where[:, own] + p, axis=1)
                        np.add.at(grad[p], (seen, np.arange(FILTERS)), back[:, own])
                    grads.append(grad)
                grads += [back.sum(axis=0), hidden.T @ error + 1e-4 * self.dense, error.sum(axis=0)]
                step += 1
                for p, g, m, s in zip(params, grads, mean, square):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        self.fold()
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and mean probability of each whole text; `und` and 0 without a letter."""
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return labels, scores
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        held, owner, rows = [], [], 0

        def flush() -> None:
            x, of = np.concatenate(held), np.concatenate(owner)
            for at in range(0, len(x), SLICE):
                np.add.at(sums, of[at : at + SLICE], self.probabilities(x[at : at + SLICE]))
            held.clear()
            owner.clear()

        for k, text in enumerate(texts):
            if not text or not _LETTER.search(text):
                continue
            cut = windows(text)
            counts[k] = len(cut)
            # Long texts are scored a slice at a time, so that only their bytes are held whole.
            for at in range(0, len(cut), 4 * SLICE):
                part = cut[at : at + 4 * SLICE]
                held.append(part)
                owner.append(np.full(len(part), k))
                rows += len(part)
                if rows >= 4 * SLICE:
                    flush()
                    rows = 0
        if held:
            flush()
        for k in np.flatnonzero(counts).tolist():
            mean = sums[k] / counts[k]
            best = int(mean.argmax())
            labels[k], scores[k] = self.languages[best], float(min(1.0, mean[best]))
        return labels, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(id_col: str = "doc_id"):
    return text_remainder(id_col, 4) == 2


def training_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = DOCS_PER_LANGUAGE, bound: int = DOCS
) -> list:
    """(lang, slices of text) of a bounded sample: of each language the same number of its distinct documents, in the order of a hash.

    Every language is learnt: all share the bound, up to `per_language` documents each and one at least. Held-out
    rows, null languages and null ids are no part of it. A document is an id with its text, so copies under one
    id count once and an id that repeats in several languages stands in each. Only bounded slices reach the driver.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col) & F.col(id_col).isNotNull())
    size = F.length(text_col)
    step = F.greatest(F.lit(1), F.floor(size / SLICES_PER_DOC)).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), F.lit(SLICES_PER_DOC - 1)), lambda k: F.substring(F.col(text_col), (k * step + 1).cast("int"), F.lit(WINDOW)))
    hashed = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("hash"), cuts.alias("cuts"))
    # A language's first hashes lie in the lowest part that holds as many as wanted and more, so no task ranks a whole
    # language. Eight times the spread and 32 rows are added: that too few lie there has a chance below 1e-14.
    known = hashed.groupBy("lang").agg(F.approx_count_distinct("hash").alias("docs"))
    found = known.limit(SENT + 1).collect()
    # A row a language is sent to all tasks where they are few, so that no language is shuffled whole.
    few = len(found) <= SENT
    number = len(found) if few else known.count()
    share = max(1, min(per_language, bound // max(1, number)))
    sizes = F.broadcast(docs.sparkSession.createDataFrame(found, known.schema)) if few else known
    low = hashed.join(sizes, "lang").where(F.col("hash") / 2.0**64 + 0.5 <= 1.1 * (share + 8 * share**0.5 + 32) / F.col("docs"))
    distinct = low.groupBy("lang", "hash").agg(F.min("cuts").alias("cuts"))
    order = Window.partitionBy("lang").orderBy("hash", "cuts")
    chosen = distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= share)
    return chosen.select("lang", "cuts", "hash").orderBy("lang", "hash").collect()


def slices(cut: str) -> np.ndarray:
    """The windows of a slice that are learnt from: all that are full or nearly so, and the first."""
    x = windows(cut)
    return x if len(x) < 2 or len(cut.encode("utf-8", "replace")) % WINDOW >= LEAST_BYTES or not len(cut.encode("utf-8", "replace")) % WINDOW else x[:-1]


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = DOCS_PER_LANGUAGE, bound: int = DOCS
) -> ByteNet:
    """Fit on the bounded sample; without labelled text the network knows no language and answers `und`."""
    rows = training_rows(docs, id_col, text_col, lang_col, per_language, bound)
    languages = sorted({r["lang"] for r in rows})
    number = {lang: k for k, lang in enumerate(languages)}
    net = ByteNet(languages)
    x, y = [], []
    for row in rows:
        for cut in dict.fromkeys(c for c in row["cuts"] if c and _LETTER.search(c)):
            found = slices(cut)
            x.append(found)
            y.append(np.full(len(found), number[row["lang"]]))
    return net.fit(np.concatenate(x), np.concatenate(y)) if x else ByteNet([])


def identify(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, lang_pred, score) of every row of `docs`, from the whole text alone.

    Null texts and texts without a letter get `und` and score 0. Rows are never merged; columns not
    in `keep` are left out, so clashing names do no harm.
    """
    small_batches(docs.sparkSession)
    columns = [id_col, *(keep or [])]
    narrow = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores = net.predict(batch.column(len(columns)).to_pylist())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(columns)], pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*columns, "lang_pred", "score"]
        )

    return over_batches(narrow, narrow.columns, run, f"{schema}, lang_pred string, score double")
