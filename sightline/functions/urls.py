"""Hosts and URLs as Spark columns."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import fixed
from .text import or_empty, strip


@F.arrow_udf(StringType())
def _idna(hosts: pa.Array) -> pa.Array:
    def ascii_host(host: str | None) -> str | None:
        try:
            return None if host is None else host.encode("idna").decode("ascii")
        except UnicodeError:
            return ""

    return pa.array([ascii_host(h) for h in hosts.to_pylist()], pa.string())


def _clean_host(host: Column) -> Column:
    """Lower-cased, without trailing dots, IDNA if not ASCII, without one leading `www.`; null if invalid."""
    low = F.lower(F.regexp_replace(host, r"\.+$", ""))
    low = F.coalesce(_idna(F.when(low.rlike(r"[^\x00-\x7f]"), low)), low)
    valid = (low != "") & ~low.rlike(r"(^|\.)(\.|$)|[^.]{64,}|[\s]")
    return F.when(valid, F.regexp_replace(low, r"^www\.", ""))


def normalize_host(c: Column) -> Column:
    """Host of a URL or bare host name, null if there is none."""
    text = strip(or_empty(c))
    whole = F.when(text.contains("://"), text).otherwise(F.concat(F.lit("https://"), text))
    authority = F.regexp_extract(whole, r"^[^:/?#]*://([^/?#]*)", 1)
    return _clean_host(F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[^\]]*$", "")))


def registrable_domain(host: Column) -> Column:
    """Last two labels, three after a suffix of two labels."""
    labels = F.split(host, r"\.")
    last = F.slice(labels, -2, 2)
    return F.when(F.size(labels) <= 2, host).when(
        F.array_join(last, ".").isin(*fixed.DOUBLE_SUFFIXES), F.array_join(F.slice(labels, -3, 3), ".")
    ).otherwise(F.array_join(last, "."))


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")), c)


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


class Url(NamedTuple):
    canonical: Column
    host: Column
    removed: Column


def normalize_url(c: Column) -> Url:
    """Canonical URL, its host, and the sorted tracking keys taken out; nulls for anything but http(s)."""
    text = F.replace(strip(or_empty(c)), F.lit("\\/"), F.lit("/"))
    scheme = F.lower(F.regexp_extract(text, r"(?i)^(https?)://", 1))
    authority = F.regexp_replace(F.regexp_extract(text, r"^[^:/?#]+://([^/?#]*)", 1), r"^.*@", "")
    port = F.regexp_extract(authority, r":([^:\]]*)$", 1)
    host = _clean_host(F.regexp_replace(authority, r":[^:\]]*$", ""))
    bad_port = (port != "") & ~(port.rlike("^[0-9]{1,5}$") & (F.coalesce(port.try_cast("int"), F.lit(99999)) <= 65535))
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    path = F.regexp_replace(F.regexp_extract(text, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)

    def pair(item: Column) -> Column:
        plain = F.replace(item, F.lit("+"), F.lit(" "))
        return F.struct(
            _decode(F.substring_index(plain, "=", 1)).alias("k"),
            F.when(plain.contains("="), _decode(F.regexp_replace(plain, "^[^=]*=", ""))).otherwise("").alias("v")
        )

    def tracks(p: Column) -> Column:
        return F.startswith(F.lower(p["k"]), F.lit("utm_")) | F.lower(p["k"]).isin(*fixed.TRACKING_KEYS)

    pairs = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), pair)
    kept = F.array_sort(F.filter(pairs, lambda p: ~tracks(p)))
    spelt = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    url = F.concat(
        scheme, F.lit("://"), host, F.when(default, "").otherwise(F.concat(F.lit(":"), port)), path,
        F.when(spelt != "", F.concat(F.lit("?"), spelt)).otherwise("")
    )
    good = (scheme != "") & host.isNotNull() & ~bad_port
    removed = F.array_sort(F.transform(F.filter(pairs, tracks), lambda p: p["k"]))
    return Url(F.when(good, url), F.when(good, host), F.when(good, removed))


def domain_matches(host: Column, domain: Column) -> Column:
    """Whether a host is a domain or one of its subdomains."""
    return (host == domain) | F.endswith(host, F.concat(F.lit("."), domain))


def suffixes(host: Column) -> Column:
    """All dot suffixes of a host, longest first: an equi-join key for domain matches."""
    labels = F.split(host, r"\.")
    return F.when(host.isNotNull(), F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))
