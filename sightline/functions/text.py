"""Text functions as Spark columns."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import fixed

#: Characters that Python strips as white space, spelt for Java.
SPACE = r"\t-\r\x1c-\x20\x85\xa0  -     　"
WORD = r"\p{L}\p{N}_"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves composed letters apart, whatever form it is asked for.
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _folded(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t).casefold() for t in texts.to_pylist()], pa.string())


def _beyond_ascii(c: Column) -> Column:
    """Null for plain ASCII, so that only other texts are sent to Python."""
    return F.when(c.rlike(r"[^\x00-\x7f]"), c)


def nfkc(c: Column) -> Column:
    return F.coalesce(_nfkc(_beyond_ascii(c)), c)


def casefold(c: Column) -> Column:
    """NFKC and case folding."""
    return F.coalesce(_folded(_beyond_ascii(c)), F.lower(c))


def normalize_text(c: Column) -> Column:
    """NFKC, case folded, dashes unified, white space collapsed and stripped; null is empty (F1)."""
    dashes = F.regexp_replace(casefold(or_empty(c)), "[\\u2010-\\u2015\\u2212]", "-")
    return F.trim(F.regexp_replace(dashes, f"[{SPACE}]+", " "))


def normalize_alias(c: Column) -> Column:
    """Normalised text with one blank for each run of other characters than letters, digits and `_` (F2)."""
    return F.trim(F.regexp_replace(normalize_text(c), f"[^{WORD}]+", " "))


def alias_pattern(alias: Column) -> Column:
    """Pattern that finds an alias: a blank stands for any run of blanks, `-`, `_`, `.`; edges of words hold."""
    plain = nfkc(strip(alias))
    quoted = F.regexp_replace(plain, r"([\\\[\]{}()*+?.^$|#&~-])", r"\\$1")
    body = F.replace(quoted, F.lit(" "), F.lit(rf"[{SPACE}\-_\.]*"))
    left = F.when(plain.rlike(r"^[\p{L}\p{N}]"), F.lit(f"(?<![{WORD}])")).otherwise("")
    right = F.when(plain.rlike(r"[\p{L}\p{N}]$"), F.lit(f"(?![{WORD}])")).otherwise("")
    return F.concat(F.lit("(?iu)"), left, body, right)


def spans(text: Column, pattern: Column, alias: Column) -> Column:
    """All matches of a pattern column as (alias, matched_text, start, end), in code points.

    Gaps and matches alternate, so an offset is the length of all before it.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<alias:string,matched_text:string,start:int,end:int>>").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = (state["at"] + F.length(pair["gap"])).cast("int")
        end = (begin + F.length(pair["hit"])).cast("int")
        row = F.struct(alias.alias("alias"), pair["hit"].alias("matched_text"), begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(row)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    return F.aggregate(pairs, start, step)["out"]


def first_position(text: Column, pattern: Column) -> Column:
    """Code-point offset of the first match, null without one: the text is searched once, up to there."""
    return F.transform(F.array(F.split(text, pattern, 2)), lambda parts: F.when(F.size(parts) > 1, F.length(parts[0])))[0]


def normalize_name(c: Column) -> Column:
    """Lower-cased `[a-z0-9]` tokens, blank-separated."""
    return F.trim(F.regexp_replace(F.lower(or_empty(c)), "[^a-z0-9]+", " "))


def contains_name(text: Column, name: Column) -> Column:
    """Whether the tokens of a name stand in the text (F8); an empty name stands nowhere."""
    needle = normalize_name(name)
    return (needle != "") & F.contains(F.concat(F.lit(" "), normalize_name(text), F.lit(" ")), F.concat(F.lit(" "), needle, F.lit(" ")))


def entity_pattern(name: Column) -> Column:
    """Pattern of an entity name across camel case, blanks, `_` and `-`; null for a name without tokens."""
    tokens = F.regexp_extract_all(F.lower(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", " ")), F.lit("[a-z0-9]+"), F.lit(0))
    body = F.array_join(tokens, f"[{SPACE}_-]*")
    return F.when(F.size(tokens) > 0, F.concat(F.lit("(?i)(?<![a-z0-9])"), body, F.lit("(?![a-z0-9])")))


def normalize_template(c: Column) -> Column:
    return F.regexp_replace(casefold(strip(or_empty(c))), f"[{SPACE}]+", " ")


def percent(numerator: Column, denominator: Column) -> Column:
    """Half-up whole percent as text, `—` for a zero denominator."""
    n, d = numerator.cast("long"), denominator.cast("long")
    return F.when(d > 0, F.concat(F.floor((200 * n + d) / (2 * d)).cast("string"), F.lit("%"))).otherwise("—")


def average_display(total: Column, count: Column) -> Column:
    """Half-up average with one decimal as `#x.y`, `—` for no values."""
    tenths = F.floor((20 * total.cast("long") + count.cast("long")) / (2 * count.cast("long"))).cast("long")
    return F.when(count > 0, F.concat(F.lit("#"), F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))).otherwise("—")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, null for a zero denominator."""
    return F.when(denominator != 0, numerator.cast("double") / denominator)


def number_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(fixed.NUMBER), F.lit(0))


def fact_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(fixed.FACT_TOKEN), F.lit(1))


def has_free_number(c: Column) -> Column:
    """Whether a digit of any script stands outside fact tokens."""
    return F.regexp_replace(c, fixed.FACT_TOKEN, "").rlike(r"\p{Nd}")


def stable_id(prefix: str, **fields: Column) -> Column:
    """`prefix-` and 16 hex digits of the fields' hash, as a JSON object with its names in order and without blanks (F16)."""
    value = F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]), {"ignoreNullFields": "false"})
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(value, 256), 1, 16))


def fact_display(fact: Column) -> Column:
    """Text of a fact variant: its `display` if it has one, else the value itself."""
    own = F.try_variant_get(fact, "$.display", "string")
    flag = F.when(F.schema_of_variant(fact) == "BOOLEAN", F.when(F.try_variant_get(fact, "$", "boolean"), fixed.YES).otherwise(fixed.NO))
    return F.coalesce(own, flag, F.try_variant_get(fact, "$", "string"), F.lit("—"))
