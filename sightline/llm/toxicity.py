"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes: threats, targets, negations and reporting verbs are fixed lists, insults are fixed
words and stems learnt from a bounded sample of labelled documents. Five weighted transducers (negation,
reported speech, target, insult, threat) are composed once into one machine, whose arcs carry the
sum of their weights. The weight of a clause is that of its best path; paths may take a hit or pass it by.
A text's score combines all its matched clauses, never single words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_batches, small_batches
from .quality import sample_labels

#: Bound of the fit: labelled documents, half of them toxic where there are as many.
FIT_DOCS = 4000
THRESHOLD = 0.5
STEM = 5
#: Toxic texts that a learnt stem or word must newly explain, or one in 200 of them if that is more.
LEAST_GAIN = 4

# English word lists of the grammar.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown")
THREATS = ("kill", "hurt", "destroy", "beat", "burn", "shoot", "stab")
TARGETS = ("you", "your", "he", "she", "they", "them", "him", "her", "these", "those")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "wasn't", "don't", "without")
REPORTERS = ("said", "says", "wrote", "quoted", "called", "claimed", "reported", "according")

_END = re.compile(r"[.!?;\n]")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

#: What a path may find in a clause: an insult or a threat, bare or in a context that raises or lowers its weight.
HITS, CONTEXTS = ("insult", "threat"), ("", " at a target", " negated", " reported")
READINGS = (*(h + c for h in HITS for c in CONTEXTS), "none")
#: Chance that a clause of this reading makes its text toxic, before labels are seen, and how many labelled texts
#: it counts as. A word alone is not enough; with a target it is.
PRIOR = dict(zip(READINGS, (0.35, 0.9, 0.15, 0.2, 0.15, 0.6, 0.05, 0.1, 0.02)))
PRIOR_COUNT = 3.0

#: An arc of a transducer: input class -> [(next state, output class, reading that it completes or None)].
Machine = dict[int, dict[str, list[tuple[int, str, str | None]]]]
CLASSES = ("insult", "threat", "target", "negation", "reporter", "w")


def _passing(state: int, classes: tuple[str, ...]) -> dict[str, list]:
    return {c: [(state, c, None)] for c in classes}


def grammar_machines() -> list[Machine]:
    """The five transducers; each reads what the one before it writes."""
    # A negation holds for the next three words.
    negation: Machine = {0: _passing(0, CLASSES)}
    for k in (1, 2, 3):
        negation[k] = {c: [(k - 1, c, None)] for c in ("target", "reporter", "w")} | {h: [(0, h + " negated", None)] for h in HITS}
    for k in range(4):
        negation[k]["negation"] = [(3, "w", None)]
    read = tuple(c for c in CLASSES if c != "negation") + tuple(h + " negated" for h in HITS)
    # What follows a reporting verb is said by someone else.
    reported: Machine = {
        0: _passing(0, read) | {"reporter": [(1, "w", None)]},
        1: _passing(1, read) | {"reporter": [(1, "w", None)]} | {h: [(1, h + " reported", None)] for h in HITS}
    }
    read = tuple(c for c in read if c != "reporter") + tuple(h + " reported" for h in HITS)
    # A hit is aimed at a target before it, or at one of the next two words: a path that foresees one must find it (states 2 and 3).
    target: Machine = {
        0: _passing(0, read) | {"target": [(1, "w", None)]} | {h: [(0, h, None), (2, h + " at a target", None)] for h in HITS},
        1: _passing(1, read) | {"target": [(1, "w", None)]} | {h: [(1, h + " at a target", None)] for h in HITS},
        2: {"target": [(1, "w", None)], "w": [(3, "w", None)]},
        3: {"target": [(1, "w", None)]},
    }
    # A path takes one hit at most: it may pass a hit by, or complete a reading with it.
    machines = [negation, reported, target]
    for hit in HITS:
        own = tuple(hit + c for c in CONTEXTS)
        other = tuple(h + c for h in HITS if h != hit for c in CONTEXTS)
        taken = {c: [(0, "w", None), (1, "w", c)] for c in own}
        machines.append({0: _passing(0, ("w", *other)) | taken, 1: _passing(1, ("w", *other)) | {c: [(1, "w", None)] for c in own}})
    return machines


class Composed(NamedTuple):
    """One machine over CLASSES: `arcs[state][class]` lists (next state, reading completed or None); state 0 starts, those of `final` end."""

    arcs: list[dict[str, list[tuple[int, str | None]]]]
    final: frozenset[int]


def compose(machines: list[Machine], final: Callable[[tuple[int, ...]], bool]) -> Composed:
    """The composition of transducers, over the states that can be reached; an arc keeps the readings its parts complete."""
    places, arcs, todo = {(0,) * len(machines): 0}, [], [(0,) * len(machines)]
    while todo:
        state = todo.pop(0)
        own: dict[str, list[tuple[int, str | None]]] = {}
        for c in CLASSES:
            paths = [((), c, None)]
            for machine, k in zip(machines, state):
                paths = [((*done, to), out, given or reading) for done, at, reading in paths for to, out, given in machine[k].get(at, ())]
            for to, _, reading in paths:
                if to not in places:
                    places[to] = len(places)
                    todo.append(to)
                own.setdefault(c, []).append((places[to], reading))
        arcs.append(own)
    return Composed(arcs, frozenset(k for state, k in places.items() if final(state)))


#: The third machine, of targets, may not end while it awaits one.
COMPOSED = compose(grammar_machines(), lambda state: state[2] < 2)


class Grammar(NamedTuple):
    """`words` and `stems` (beginnings of words) that insult; `weights` are chances by reading."""

    words: tuple[str, ...]
    stems: tuple[str, ...]
    weights: dict

    def trigger(self) -> re.Pattern:
        """Finds a word that some reading can start from; texts without one match nothing."""
        exact, begin = sorted({*self.words, *THREATS}), sorted(self.stems)
        parts = [r"(?:" + "|".join(map(re.escape, exact)) + r")(?![^\W\d_])"] + ([r"(?:" + "|".join(map(re.escape, begin)) + ")"] if begin else [])
        return re.compile(r"(?<![^\W\d_])(?:" + "|".join(parts) + ")")

    def classes(self, words: list[str]) -> list[str]:
        out = []
        for w in words:
            insult = w in self.words or w.startswith(self.stems)
            out.append(
                "insult" if insult else "threat" if w in THREATS else "target" if w in TARGETS else "negation" if w in NEGATIONS else "reporter" if w in REPORTERS else "w"
            )
        return out

    def log_odds(self) -> dict:
        """Weights of arcs: a reading's log odds over those of a clause without any."""
        odds = {r: float(np.log(p / (1 - p))) for r, p in self.weights.items()}
        return {r: w - odds["none"] for r, w in odds.items()}

    def reading(self, clause: str, weights: dict | None = None) -> str:
        """Reading of a lower-cased clause: that of the best path through the composed machine."""
        weights = weights or self.log_odds()
        best = {0: (0.0, "none")}
        for c in self.classes(_WORD.findall(clause)):
            step: dict[int, tuple[float, str]] = {}
            for state, (weight, reading) in best.items():
                for to, given in COMPOSED.arcs[state].get(c, ()):
                    # Over two hits a path would count one clause twice; it keeps the heavier.
                    found = (weight, reading) if given is None else max((weight, reading), (weights[given], given))
                    if to not in step or found > step[to]:
                        step[to] = found
            best = step
        return max(found for state, found in best.items() if state in COMPOSED.final)[1]

    def readings(self, text: str, trigger: re.Pattern, weights: dict | None = None) -> Counter:
        """How many clauses of the whole text have each reading; clauses are cut once."""
        low = text.lower()
        counts: Counter = Counter()
        first = trigger.search(low)
        if first is None:
            return counts
        weights = weights or self.log_odds()
        ends = [m.start() for m in _END.finditer(low)]
        done = -1
        for m in trigger.finditer(low, first.start()):
            if m.start() < done:
                continue
            k = bisect_left(ends, m.start())
            start, end = ends[k - 1] + 1 if k else 0, ends[k] if k < len(ends) else len(low)
            reading = self.reading(low[start:end], weights)
            if reading != "none":
                counts[reading] += 1
            done = end
        return counts

    def score(self, counts: Counter) -> float:
        """Chance that some clause is toxic: the heaviest clause counts whole, each other one as a half."""
        clean = 1 - self.weights["none"]
        if counts:
            top = max(self.weights[r] for r in counts)
            clean *= reduce(lambda a, r: a * (1 - self.weights[r] / 2) ** counts[r], sorted(counts), 1.0) * (1 - top) / (1 - top / 2)
        return float(min(1.0, max(0.0, 1 - clean)))


def candidates(text: str) -> list[str]:
    """Distinct words of a text, and beginnings of STEM letters marked with a star."""
    words = set(_WORD.findall(text.lower()))
    return sorted(words | {w[:STEM] + "*" for w in words if len(w) > STEM})


def learn_lexicon(texts: DataFrame, toxic: int, least: int = LEAST_GAIN) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Words and stems that explain toxic texts of `texts(text, label)`, `toxic` of which are toxic: greedily the candidate found
    in most texts not yet explained, of those that at most one in fifty of its texts is clean.

    Candidates are counted in Spark; only the numbers of the toxic texts of good ones reach the driver.
    """
    least = max(least, toxic // 200)
    fixed = "(?i)(?<![\\p{L}])(?:" + "|".join(INSULTS) + ")(?![\\p{L}])"
    rows = texts.where(~((F.col("label") == 1) & F.col("text").rlike(fixed)))

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [candidates(t) for t in batch.column(0).to_pylist()]
        take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        return pa.RecordBatch.from_arrays(
            [pa.array([c for f in found for c in f], pa.string()), batch.column(1).take(take), batch.column(2).take(take)], names=["candidate", "label", "key"]
        )

    held = over_batches(rows.withColumn("key", F.xxhash64("text")), ["text", "label", "key"], split, "candidate string, label int, key long")
    wanted = held.groupBy("candidate").agg(
        F.sum("label").alias("n"), F.sum(1 - F.col("label")).alias("clean"), F.collect_list(F.when(F.col("label") == 1, F.col("key"))).alias("keys")
    )
    good = {
        r["candidate"]: set(r["keys"]) for r in wanted.where(
            (F.col("n") >= least) & (F.col("clean") <= 0.02 * F.col("n"))
        ).select("candidate", "keys").collect()
    }
    picked: list[str] = []
    while good:
        best = min(good, key=lambda c: (-len(good[c]), c))
        if len(good[best]) < least:
            break
        picked.append(best)
        explained = good.pop(best)
        good = {c: left for c, keys in good.items() if len(left := keys - explained) >= least}
    return tuple(sorted({*INSULTS, *(c for c in picked if not c.endswith("*"))})), tuple(sorted(c[:-1] for c in picked if c.endswith("*")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bound: int = FIT_DOCS) -> Grammar:
    """Learn insults and the weights of readings from a bounded sample of labelled documents.

    Ids with crc32 divisible by 5, null ids and other labels are not learnt from. For the words exact copies
    count once, as toxic if any of them is.
    """
    small_batches(docs.sparkSession)
    chosen = sample_labels(labels, id_col, label_col, bound)
    known = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col).where(F.col("text").isNotNull())
    texts = known.groupBy("text").agg(F.max("label").alias("label"))
    grammar = Grammar(*learn_lexicon(texts, texts.where("label = 1").count()), dict(PRIOR))
    trigger, prior = grammar.trigger(), grammar.log_odds()

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [grammar.readings(t, trigger, prior) for t in batch.column(0).to_pylist()]
        best = [max(c, key=lambda k: (PRIOR[k], k), default="none") for c in found]
        return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(best, pa.string())], names=["label", "share", "reading"])

    tally = over_batches(
        known, ["text", "label", "share"], read, "label int, share double, reading string"
    ).groupBy("reading").agg(F.sum("share").alias("n"), F.sum(F.col("share") * F.col("label")).alias("toxic")).collect()
    seen = {r["reading"]: (r["n"], r["toxic"]) for r in tally}
    weights = {}
    for reading, chance in PRIOR.items():
        n, hits = seen.get(reading, (0.0, 0.0))
        weights[reading] = float(np.clip((hits + PRIOR_COUNT * chance) / (n + PRIOR_COUNT), 0.001, 0.999))
    return grammar._replace(weights=weights)


def score(
    docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """(id, *keep, score, predicted, reading) of every row, from the whole text alone.

    `reading` is the heaviest reading of a clause, or `none`. Null and empty texts have none.
    """
    small_batches(docs.sparkSession)
    columns = [id_col, *(keep or [])]
    narrow = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    trigger, weights = grammar.trigger(), grammar.log_odds()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [grammar.readings(t or "", trigger, weights) for t in batch.column(len(columns)).to_pylist()]
        scores = [grammar.score(c) for c in found]
        best = [max(c, key=lambda k: (grammar.weights[k], k), default="none") for c in found]
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[: len(columns)], pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                pa.array(best, pa.string())
            ],
            names=[*columns, "score", "predicted", "reading"]
        )

    return over_batches(narrow, narrow.columns, run, f"{schema}, score double, predicted int, reading string")
