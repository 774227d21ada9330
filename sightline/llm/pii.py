"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

The field reads windows of tokens around digits and @ signs. Whole candidate segments are scored by
features of their span; a dynamic programme over bounded segments chooses boundaries and kinds
together. It is trained on windows of a bounded sample, with the base matches as labels, and on the same
windows with their matches made unsound, or with emails and cards broken up so that no pattern finds them.
Windows where a pattern ran on into its neighbour and was dropped are not learnt from: there the field
finds what the pattern swallowed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_batches, small_batches

KINDS = ("email", "ip", "card", "phone")
#: Bound of the fit: documents, windows of them, and tokens of a window; longer windows are not learnt from.
FIT_DOCS, FIT_WINDOWS, FIT_TOKENS = 400, 600, 60
EPOCHS = 5
#: Tokens in one entity (a card of 19 digits may have each in a token of its own), and tokens around a digit or @ that a window takes in.
SEGMENT, AROUND = 19, 2
#: Digits of an entity of several tokens: no kind has more.
DIGITS = 19
#: A span is added if the field prefers it to no entity by this much (log odds).
MARGIN = 0.5

# The base patterns. Look-behinds only keep a search from starting anew inside a run
# of digits that it has already tried; matches are the same.
_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HOT = re.compile(r"(?<!\S)\S*[0-9@]\S*")
_TOKEN = re.compile(r"\S+")
_HOT_TOKEN = re.compile("[0-9@]")
_EDGE_LEFT, _EDGE_RIGHT = "([{<\"'$#%&*|~^=", ".,;:!?)]}>\"'$#%&*|~^=_"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0") or "0"
    return len(digits) <= 3 and int(digits) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, sorted; offsets are code points, ends exclusive."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(found)


def swallows(text: str) -> bool:
    """Whether a pattern matches more digits than its kind may have, as where a phone and a card stand side by side."""
    digits = lambda pattern: max((len(_DIGIT.findall(m[0])) for m in pattern.finditer(text)), default=0)
    return digits(_CARD) > 19 or digits(_PHONE) > 15


def unsound(text: str) -> str:
    """The text with its base matches but emails spoilt: an octet too large, a wrong check digit, a phone cut short."""
    out, at = [], 0
    for start, kind, end in base_spans(text):
        if not kind or start < at:
            continue
        span = text[start:end]
        if kind == 1:
            span = "999" + span
        elif kind == 2:
            span = span[:-1] + str((int(span[-1]) + 1) % 10)
        else:
            span = span[: [m.end() for m in _DIGIT.finditer(span)][6]]
        out += [text[at:start], span]
        at = end
    return "".join([*out, text[at:]])


def broken(text: str, sound: bool = True) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its emails and cards written so that no base pattern finds them, and where they then are.

    An email gets blanks around its @, a card two blanks between groups of four digits. Unless `sound`, none is
    left: an email also loses its domain but for the first label, a card gets a wrong check digit.
    """
    out, found, at, size = [], [], 0, 0
    for start, kind, end in base_spans(text):
        if kind not in (0, 2) or start < at:
            continue
        span = text[start:end]
        if kind == 0:
            span = span.replace("@", " @ ") if sound else " @ ".join(x.split(".")[0] for x in span.split("@"))
        else:
            digits = "".join(_DIGIT.findall(span))
            digits = digits if sound else digits[:-1] + str((int(digits[-1]) + 1) % 10)
            span = "  ".join(digits[k : k + 4] for k in range(0, len(digits), 4))
        out += [text[at:start], span]
        size += start - at
        if sound:
            found.append((size, kind, size + len(span)))
        size += len(span)
        at = end
    return "".join([*out, text[at:]]), found


Tokens = list[tuple[int, int]]


def windows(text: str) -> Iterator[Tokens]:
    """Tokens around each run of tokens that hold a digit or @, with up to AROUND neighbours."""
    held: Tokens = []
    last_hot = -1
    for m in _HOT.finditer(text):
        left: Tokens = []
        at = m.start()
        while len(left) < AROUND and at > last_hot + 1:
            stop = at
            while stop > last_hot + 1 and text[stop - 1].isspace():
                stop -= 1
            begin = stop
            while begin > last_hot + 1 and not text[begin - 1].isspace():
                begin -= 1
            if begin == stop:
                break
            left.append((begin, stop))
            at = begin
        left.reverse()
        if held:
            right: Tokens = []
            for n in _TOKEN.finditer(text, held[-1][1]):
                if len(right) >= AROUND or n.start() >= m.start():
                    break
                right.append(n.span())
            seen = set(right)  # tokens to the left lie behind the last hot one, as do these
            if not left or left[0][0] <= (right[-1][1] if right else held[-1][1]) + 1:
                held += right + [t for t in left if t not in seen]
            else:
                yield held + right
                held = left
        else:
            held = left
        held.append(m.span())
        last_hot = m.end() - 1
    if held:
        right = []
        for n in _TOKEN.finditer(text, held[-1][1]):
            if len(right) >= AROUND:
                break
            right.append(n.span())
        yield held + right


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without brackets, quotes, stops and signs at its edges."""
    while start < end and text[start] in _EDGE_LEFT and not (text[start] == "(" and _DIGIT.match(text, start + 1)):
        start += 1
    while end > start and text[end - 1] in _EDGE_RIGHT:
        end -= 1
    return start, end


#: Spans up to this length keep their features in a table; longer ones are looked at anew.
KEPT_LENGTH = 200
SUMS = 100_000


def features(span: str, before: str) -> tuple[str, ...]:
    """Whole-span features of a candidate segment and the word before it."""
    return _kept_features(span, before) if len(span) <= KEPT_LENGTH else _features(span, before)


def _features(span: str, before: str) -> tuple[str, ...]:
    digits = "".join(_DIGIT.findall(span))
    n = len(digits)
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[0-9]+", "0", span.lower()))
    out = [
        f"digits {min(n, 20)}", f"shape {shape}", f"before {before}", f"first {shape[:1]}", f"dots {min(span.count('.'), 5)}",
        f"tokens {len(span.split())}"
    ]
    if "@" in span:
        out.append("at" + (" in words" if re.fullmatch(r"[a-z0-9._%+-]*[a-z0-9] ?@ ?[a-z0-9-]+(\.[a-z0-9-]+)+", span.lower()) else ""))
    if 12 <= n <= 19 and re.fullmatch(r"[0-9][0-9 .-]+", span):
        out.append(f"luhn {luhn(digits)}")
    parts = span.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append(f"octets {all(len(p) < 4 and int(p) < 256 for p in parts)}")
    if span.startswith("+"):
        out.append(f"plus {9 <= n <= 15}")
    if not n and "@" not in span:
        out.append("plain")
    return tuple(out)


_kept_features = lru_cache(maxsize=100_000)(_features)


#: What a span must be to be of a kind at all, as a feature: label -> feature.
NEEDED = {1: "at in words", 2: "octets True", 3: "luhn True", 4: "plus True"}


class SpanField:
    """Weights by (feature, label); label 0 is no entity, then KINDS."""

    def __init__(self):
        self.weights: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(KINDS) + 1))
        #: Sums of weights that decoding has met, at most SUMS.
        self.sums: dict[tuple, tuple[float, int]] = {}

    def __getstate__(self):
        return dict(self.weights)

    def __setstate__(self, state):
        self.__init__()
        self.weights.update(state)

    def segments(self, text: str, tokens: Tokens) -> Iterator[tuple[int, int, tuple[str, ...], bool]]:
        """(first, last + 1, features, may be an entity) of each candidate, by its first token; entities begin and end in tokens with a digit or @, or beside an @."""
        hot = [bool(_HOT_TOKEN.search(text, a, b)) for a, b in tokens]
        opens = [h or (k + 1 < len(tokens) and text[tokens[k + 1][0]] == "@") for k, h in enumerate(hot)]
        closes = [h or (k > 0 and text[tokens[k - 1][1] - 1] == "@") for k, h in enumerate(hot)]
        for i in range(len(tokens)):
            before = re.sub("[^a-z]", "", text[slice(*tokens[i - 1])].lower()) if i else ""
            digits = 0
            for j in range(i + 1, min(len(tokens), i + SEGMENT) + 1):
                if j > i + 1 and (not opens[i] or (j > i + 3 and not hot[i])):
                    break
                digits += len(_DIGIT.findall(text, *tokens[j - 1])) if hot[j - 1] else 0
                if j > i + 1 and digits > DIGITS:
                    break
                if not closes[j - 1] and j > i + 1:
                    continue
                start, end = trimmed(text, tokens[i][0], tokens[j - 1][1])
                yield i, j, features(text[start:end], before), opens[i] and closes[j - 1] and any(hot[i:j]) and start < end

    def scores(self, found: tuple[str, ...], entity: bool, single: bool) -> np.ndarray:
        total = np.zeros(len(KINDS) + 1)
        for f in found:
            w = self.weights.get(f)
            if w is not None:
                total = total + w
        for label, needed in NEEDED.items():
            if not entity or needed not in found:
                total[label] = -np.inf
        if not single:
            total[0] = -np.inf
        return total

    def fit(
        self, samples: list[tuple[str, Tokens]] | list[tuple[str, Tokens, list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.2, seed: int = 3
    ) -> SpanField:
        """Stochastic gradient of the log-likelihood; expectations by forward and backward sums.

        A sample's entities are its third part, else its base matches.
        """
        rng = np.random.default_rng(seed)
        self.sums.clear()
        prepared = [(list(self.segments(text, tokens)), len(tokens), self._gold(tokens, *(given or [base_spans(text)]))) for text, tokens, *given in samples]
        for _ in range(epochs):
            for k in rng.permutation(len(prepared)).tolist():
                segments, n, gold = prepared[k]
                values = [self.scores(f, e, j == i + 1) for i, j, f, e in segments]
                forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
                forward[0] = backward[n] = 0.0
                sums = [np.logaddexp.reduce(v) for v in values]
                for (i, j, _, _), s in sorted(zip(segments, sums), key=lambda x: x[0][1]):
                    forward[j] = np.logaddexp(forward[j], forward[i] + s)
                for (i, j, _, _), s in sorted(zip(segments, sums), key=lambda x: -x[0][0]):
                    backward[i] = np.logaddexp(backward[i], backward[j] + s)
                for (i, j, f, _), v in zip(segments, values):
                    change = -np.exp(forward[i] + v + backward[j] - forward[n])
                    if (i, j) in gold:
                        change[gold[i, j]] += 1
                    if np.abs(change).max() > 1e-3:
                        for name in f:
                            self.weights[name] = self.weights[name] * (1 - 1e-4) + rate * change
        return self

    @staticmethod
    def _gold(tokens: Tokens, spans: list[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
        """The segmentation that the spans give."""
        gold, at = {}, 0
        low, high = tokens[0][0], tokens[-1][1]
        for start, kind, end in spans:
            inside = [k for k, (a, b) in enumerate(tokens) if a < end and b > start]
            if start < low or end > high or not inside or inside[0] < at:
                continue
            gold.update({(k, k + 1): 0 for k in range(at, inside[0])})
            gold[inside[0], inside[-1] + 1] = kind + 1
            at = inside[-1] + 1
        gold.update({(k, k + 1): 0 for k in range(at, len(tokens))})
        return gold

    def decode(self, text: str, tokens: Tokens) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the entities in the best segmentation of a window."""
        n = len(tokens)
        best, back = np.full(n + 1, -np.inf), [None] * (n + 1)
        best[0] = 0.0
        for i, j, f, e in self.segments(text, tokens):  # in order of i
            key = (*f, e, j == i + 1)
            if key not in self.sums:
                if len(self.sums) >= SUMS:
                    self.sums.clear()
                v = self.scores(f, e, j == i + 1)
                v[1:] -= MARGIN
                self.sums[key] = (float(v.max()), int(v.argmax()))
            value, k = self.sums[key]
            if best[i] + value > best[j]:
                best[j], back[j] = best[i] + value, (i, k)
        out, j = [], n
        while j:
            i, k = back[j]
            if k:
                start, end = trimmed(text, tokens[i][0], tokens[j - 1][1])
                out.append((start, k - 1, end))
            j = i
        return out[::-1]


def find_spans(text: str, field: SpanField | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: the field adds those that overlap no base span."""
    base = base_spans(text)
    if field is None:
        return base, base
    starts, ends = [], []  # disjoint stretches that base spans cover
    for start, _, end in base:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    more = []
    for tokens in windows(text):
        for start, kind, end in field.decode(text, tokens):
            k = bisect_right(ends, start)
            if k == len(starts) or starts[k] >= end:
                more.append((start, kind, end))
    return base, sorted(base + more)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanField:
    """Fit on windows of a bounded sample: FIT_DOCS documents holding a digit or @, in the order of a hash of the id."""
    small_batches(docs.sparkSession)
    held = docs.where(F.col(text_col).rlike("[0-9@]") & F.col(id_col).isNotNull()).select(id_col, text_col)
    chosen = held.select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(FIT_DOCS).distinct()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = [], []
        for key, text in zip(batch.column(0), batch.column(1).to_pylist()):
            for tokens in windows(text):
                if len(tokens) <= FIT_TOKENS:
                    ids.append(key.as_py())
                    texts.append(text[tokens[0][0] : tokens[-1][1]])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=[id_col, "window"])

    rows = over_batches(held.join(F.broadcast(chosen), id_col), [id_col, text_col], cut, f"{id_col} long, window string")
    rows = rows.distinct().orderBy(F.xxhash64(id_col, "window"), "window").limit(FIT_WINDOWS).collect()
    return fit_windows([r["window"] for r in rows])


def fit_windows(texts: list[str]) -> SpanField:
    """The field trained on windows, on their unsound twins, and on twins whose entities are broken up."""
    samples = []
    for text in texts:
        samples += [(t, base_spans(t)) for t in dict.fromkeys((text, unsound(text))) if not swallows(t)]
        for sound in (True, False):
            twin, spans = broken(text, sound)
            if twin != text and not swallows(text):
                kept = [s for s in base_spans(twin) if not any(a < s[2] and s[0] < b for a, _, b in spans)]
                samples.append((twin, sorted(spans + kept)))
    return SpanField().fit([(t, tokens, spans) for t, spans in samples if (tokens := [m.span() for m in _TOKEN.finditer(t)])])


def find(docs: DataFrame, field: SpanField | None = None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, base and spans as arrays of (start, kind, end)) of every row; null texts are empty."""
    small_batches(docs.sparkSession)
    columns = [id_col, *(keep or [])]
    narrow = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find_spans(t or "", field) for t in batch.column(len(columns)).to_pylist()]
        both = [pa.array([[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in f[which]] for f in found], kind) for which in (0, 1)]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *both], names=[*columns, "base", "spans"])

    spans = "array<struct<start: long, kind: string, end: long>>"
    return over_batches(narrow, narrow.columns, run, f"{schema}, base {spans}, spans {spans}")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first begins."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_texts(docs: DataFrame, field: SpanField | None = None, text_col: str = "text") -> DataFrame:
    """The table itself with all found spans replaced in `text_col`; null texts stay null."""
    small_batches(docs.sparkSession)
    place, schema = docs.columns.index(text_col), docs.schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t if t is None else redact(t, find_spans(t, field)[1]) for t in batch.column(place).to_pylist()]
        columns = list(batch.columns)
        columns[place] = pa.array(texts, columns[place].type)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return over_batches(docs, docs.columns, run, schema)
