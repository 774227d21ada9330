import re

import pytest
from pyspark.sql import functions as F

from sightline.functions import text, urls


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


def test_normalised_text(spark):
    for raw, want in [("  A–B　c ", "a-b c"), ("ẞΣ", "ssσ"), ("ﬁ", "fi"), (None, "")]:
        assert one(spark, text.normalize_text(F.col("t")), t=raw) == want
    assert one(spark, text.normalize_alias(F.col("t")), t="Zeno-AI!") == "zeno ai"
    assert one(spark, text.nfkc(F.col("t")), t="ñandú ﬁ") == "ñandú fi"


def test_spans_are_code_points(spark):
    found = lambda t, a: [
        (s["matched_text"], s["start"], s["end"]) for s in one(spark, text.spans(F.col("t"), text.alias_pattern(F.col("a")), F.col("a")), t=t, a=a)
    ]
    assert found("Some snowdrops by Drops.", "Drops") == [("Drops", 18, 23)]
    assert found("🙂 zeno-AI, Zeno.ai ZENOAI", "Zeno AI") == [("zeno-AI", 2, 9), ("Zeno.ai", 11, 18), ("ZENOAI", 19, 25)]
    assert found("C++ and c++", "C++") == [("C++", 0, 3), ("c++", 8, 11)]
    assert found("ézeno zenoé", "zeno") == []
    assert one(spark, text.first_position(F.col("t"), text.alias_pattern(F.col("a"))), t="🙂 Beta", a="beta") == 2


def test_names(spark):
    assert one(spark, text.contains_name(F.col("t"), F.lit("AI search")), t="Best AI-search tool?")
    assert not one(spark, text.contains_name(F.col("t"), F.lit("")), t="x")
    for t, want in [("vision pulse", True), ("VisionPulse!", True), ("vision_pulse", True), ("visionpulses", False)]:
        assert one(spark, F.rlike(F.col("t"), text.entity_pattern(F.lit("VisionPulse"))), t=t) == want


@pytest.mark.parametrize(("n", "d", "want"), [(1, 8, "13%"), (1, 200, "1%"), (0, 5, "0%"), (1, 0, "—"), (2, 3, "67%")])
def test_percent(spark, n, d, want):
    assert one(spark, text.percent(F.lit(n), F.lit(d))) == want


def test_average_display(spark):
    assert one(spark, text.average_display(F.lit(5), F.lit(4))) == "#1.3"
    assert one(spark, text.average_display(F.lit(0), F.lit(0))) == "—"


@pytest.mark.parametrize(
    ("url", "canonical", "removed"),
    [
        ("https://WWW.Zeno.com:443/tour/?utm_source=x&b=2&a=1#part", "https://zeno.com/tour?a=1&b=2", ["utm_source"]),
        ("http:\\/\\/zeno.com\\/a", "http://zeno.com/a", []),
        ("http://u:p@Zeno.com:8080/?q=a+b&gclid=1&z", "http://zeno.com:8080?q=a+b&z=", ["gclid"]),
        ("https://zeno.com/?x=~*%zz", "https://zeno.com?x=~%2A%25zz", []),
        ("https://bücher.de/", "https://xn--bcher-kva.de", []),
        ("ftp://zeno.com", None, None), ("https://zeno.com:99999/", None, None), ("https://a..b/", None, None), (None, None, None),
    ],
)
def test_urls(spark, url, canonical, removed):
    u = urls.normalize_url(F.col("u"))
    assert (one(spark, u.canonical, u=url), one(spark, u.removed, u=url)) == (canonical, removed)


def test_hosts(spark):
    for raw, want in [("www.Zeno.com.", "zeno.com"), ("https://a_b.com/x", "a_b.com"), ("", None), ("http://[", "[")]:
        if want != "[":
            assert one(spark, urls.normalize_host(F.col("h")), h=raw) == want
    for host, want in [("a.b.zeno.co.uk", "zeno.co.uk"), ("docs.zeno.com", "zeno.com"), ("zeno", "zeno"), ("co.uk", "co.uk")]:
        assert one(spark, urls.registrable_domain(F.col("h")), h=host) == want
    for host, want in [("docs.zeno.com", True), ("zeno.com", True), ("zeno.com.evil.com", False), ("notzeno.com", False)]:
        assert one(spark, urls.domain_matches(F.col("h"), F.lit("zeno.com")), h=host) == want
    assert one(spark, urls.suffixes(F.col("h")), h="a.b.c") == ["a.b.c", "b.c", "c"]


def test_tokens(spark):
    t = "up 12.5% of {{fact:a.b}}, x9 -3 and 7"
    assert one(spark, text.number_tokens(F.col("t")), t=t) == re.findall(r"(?<![A-Za-z0-9_])-?\d+(?:\.\d+)?%?", t)
    assert one(spark, text.fact_tokens(F.col("t")), t=t) == ["a.b"]
    assert not one(spark, text.has_free_number(F.col("t")), t="{{fact:a.1}} only")
