"""URL filter: pattern rules indexed by their rarest literal token.

A rule's literal tokens are whole host labels and whole path segments. Each rule is filed under
the one of its tokens that the fewest URLs hold (counted over all URLs); a URL's tokens fetch
candidate rules, and only those run their regular expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches


class Rule(NamedTuple):
    """`host` (with its subdomains) and the start of `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return r"(?:[^/]*\.)?" + re.escape(self.host + self.path)

    def tokens(self) -> list[str]:
        """Literal tokens that any fitting URL must hold; the last path segment may go on and is none."""
        return ["." + x for x in self.host.split(".") if x] + ["/" + x for x in self.path.split("/")[1:-1] if x]


class Pattern(NamedTuple):
    """A verdict for URLs that no rule fits: `regex` is searched in host and path; any fitting URL holds all of `literals`."""

    verdict: str
    literals: tuple[str, ...]
    regex: str

    def tokens(self) -> list[str]:
        return list(self.literals)


#: Rules of the registered query.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/")
)
#: Host labels of link farms, betting, pill, tracking and adult hosts; anything else is allowed.
PATTERNS = tuple(
    Pattern("block", ("." + label,), rf"^(?:[^/]*\.)?{label}\.") for label in ("spam-farm", "free-bets", "casino-win", "cheap-pills", "ads-track", "adult-x")
)
DEFAULT = "allow"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Native host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _tokens(host: str, path: str) -> set[str]:
    """The empty token fetches the rules without any literal token."""
    return {"", *("." + x for x in host.split(".") if x), *("/" + x for x in path.split("/") if x)}


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, patterns: Sequence[Pattern] = PATTERNS, default: str = DEFAULT, id_col: str = "page_id",
    url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict) of each row; of fitting rules the longest wins, then the first.

    Without a fitting rule, `rule` is null and the verdict is that of the first fitting pattern,
    else `default`. Null or malformed urls have empty host and path. Rows are never merged.
    """
    small_batches(pages.sparkSession, 4096)
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(id_col, host.alias("host"), path.alias("path"))
    wanted = sorted({t for r in (*rules, *patterns) for t in r.tokens()})
    # A URL counts once for each token; the result has one row for each token of the rules at most.
    held = F.array_distinct(
        F.concat(F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("."), x)), F.transform(F.split("path", "/"), lambda x: F.concat(F.lit("/"), x)))
    )
    counted = parts.select(F.explode(held).alias("token")).where(F.col("token").isin(wanted)).groupBy("token").count() if wanted else None
    counts = {r["token"]: r["count"] for r in counted.collect()} if wanted else {}
    rarest = lambda r: min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
    index: dict[str, list] = {}
    for k, rule in enumerate(rules):
        index.setdefault(rarest(rule), []).append((-len(rule.name), k, rule.name, rule.verdict, re.compile(rule.pattern)))
    extra: dict[str, list] = {}
    for k, p in enumerate(patterns):
        extra.setdefault(rarest(p), []).append((k, p.verdict, re.compile(p.regex)))

    def judged(host: str, path: str) -> tuple[str | None, str]:
        tokens, where = _tokens(host, path), host + path
        for _, _, name, verdict, regex in sorted((c for t in tokens for c in index.get(t, ())), key=lambda c: c[:2]):
            if regex.match(where):
                return name, verdict
        for _, verdict, regex in sorted((c for t in tokens for c in extra.get(t, ())), key=lambda c: c[0]):
            if regex.search(where):
                return None, verdict
        return None, default

    def run(batches):
        for batch in batches:
            found = [judged(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"]
            )

    kind = dict(parts.dtypes)[id_col]
    return parts.mapInArrow(run, f"{id_col} {kind}, host string, path string, rule string, verdict string")
